"""Near-duplicate embeddings by spherical-cap filters made of random product codes."""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components
from ledgerloom.llm.workers import by_value, later_in_run, run_ends, spanning_links, whole_runs
from ledgerloom.session import staged


class CapFilters:
    """Filter directions of several tables; a direction is one random codeword per block of rotated coordinates.

    A vector is listed under every direction whose inner product with it reaches `reach`. reach is the normal quantile at
    which a vector has `lists` directions per table on average.
    """

    def __init__(self, dims: int, codewords: int, tables: int, lists: float, seed: int, blocks: int = 2):
        self.random = np.random.default_rng(seed)
        self.dims, self.codewords, self.blocks = dims, codewords, min(blocks, dims)
        self.directions, self.tables = codewords**self.blocks, 0
        self.reach = NormalDist().inv_cdf(1 - min(0.5, lists / self.directions))
        self.turns, self.codes = [], []
        for _ in range(tables):
            self.add_table()

    def add_table(self) -> None:
        parts = np.array_split(np.arange(self.dims), self.blocks)
        self.turns.append(np.linalg.qr(self.random.standard_normal((self.dims, self.dims)))[0])
        self.codes.append([self.random.standard_normal((self.codewords, len(p))) for p in parts])
        self.tables += 1

    def listed(self, units: np.ndarray, tables: range | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(vector, direction) of all exceeding directions, decoded block by block; of all tables if none are named.

        A partial code is dropped as soon as the best codewords of the blocks to come cannot lift it to reach.
        """
        rows, codes = [], []
        for table in range(self.tables) if tables is None else tables:
            turned, scores, at = units @ self.turns[table], [], 0
            for words in self.codes[table]:
                scores.append(turned[:, at : at + words.shape[1]] @ words.T)
                at += words.shape[1]
            best = np.array([s.max(axis=1) for s in scores])
            row, code, total = np.arange(len(units)), np.zeros(len(units), np.int64), np.zeros(len(units))
            for block, score in enumerate(scores):
                rest = best[block + 1 :].sum(axis=0)
                parts = []
                width = max(1, 4_000_000 // score.shape[1])
                for a in range(0, len(row), width):
                    sums = total[a : a + width, None] + score[row[a : a + width]]
                    i, j = np.nonzero(sums + rest[row[a : a + width], None] >= self.reach)
                    parts.append((row[a + i], code[a + i] * score.shape[1] + j, sums[i, j]))
                row, code, total = (np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (row, code, total)
            rows.append(row)
            codes.append(code + table * self.directions)
        return np.concatenate(rows), np.concatenate(codes)


def pairs_at(cosine: float, count: int, dims: int, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Random unit vectors and, row by row, partners at exactly this cosine (equal vectors in one dimension)."""
    a = random.standard_normal((count, dims))
    a /= np.sqrt((a * a).sum(axis=1))[:, None]
    if dims == 1:
        return a, a
    b = random.standard_normal((count, dims))
    b -= (b * a).sum(axis=1)[:, None] * a
    b /= np.sqrt((b * b).sum(axis=1))[:, None]
    return a, cosine * a + np.sqrt(1 - cosine * cosine) * b


def unmet(filters: CapFilters, a: np.ndarray, b: np.ndarray, tables: range | None = None) -> np.ndarray:
    """Which pairs of rows share no direction in these tables."""
    out = np.ones(len(a), bool)
    for at in range(0, len(a), 512):
        lists = [np.stack(filters.listed(x[at : at + 512], tables), axis=1) for x in (a, b)]
        seen, times = np.unique(np.concatenate(lists), axis=0, return_counts=True)
        out[at + seen[times > 1, 0]] = False
    return out


def enough_filters(
    dims: int, codewords: int, tables: int, lists: float, seed: int, least_cosine: float, most_missed: float, most_tables: int = 256
) -> CapFilters:
    """Filters with `tables` tables, and more until they miss few enough of ten thousand random pairs at least_cosine.

    Pairs are met at half of most_missed, so that the count, a sample, bounds the rate itself with about 93 % confidence. Only
    pairs that no table has met so far are tried on the next. The directions are random, so the rate holds for any data.
    """
    filters = CapFilters(dims, codewords, tables, lists, seed)
    count = max(10_000, int(np.ceil(10 / most_missed)))
    a, b = pairs_at(min(1.0, least_cosine), count, dims, np.random.default_rng(seed + 1))
    left = unmet(filters, a, b)
    while left.sum() > count * most_missed / 2:
        if filters.tables == most_tables:
            raise ValueError(f"{most_tables} tables miss more than {most_missed} of pairs at cosine {least_cosine}")
        a, b = a[left], b[left]
        filters.add_table()
        left = unmet(filters, a, b, range(filters.tables - 1, filters.tables))
    return filters


def unit_rows(vectors) -> np.ndarray:
    """A list column of finite floats as rows of length one, in double precision."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(vectors), -1)
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def listings(nodes: DataFrame, filters: CapFilters, with_vectors: bool) -> DataFrame:
    """A row per node and direction: label, code, and the node itself if asked for."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                row, code = filters.listed(unit_rows(part.column("vector")))
                columns = [part.column("label").take(pa.array(row)), pa.array(code)]
                names = ["label", "code"]
                if with_vectors:
                    columns += [part.column(c).take(pa.array(row)) for c in ("node", "copies", "vector")]
                    names += ["node", "copies", "vector"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "label long, code long" + (", node long, copies long, vector array<float>" if with_vectors else "")
    return nodes.mapInArrow(run, schema)


def first_common(codes_a: frozenset, codes_b: frozenset, code: int) -> bool:
    return min(codes_a & codes_b) == code


def met_pairs(units, nodes, runs, sides, codes, filters: CapFilters, least_cosine: float):
    """Verified pairs (i, j) of a sorted batch, each only under the first direction that its vectors share."""
    ends = run_ends(runs)
    starts = np.flatnonzero(np.concatenate(([True], runs[1:] != runs[:-1])))
    sizes = ends[starts] - starts
    found = []
    small = np.repeat(sizes < 64, sizes)
    for i, j in later_in_run(ends, np.flatnonzero(small), 500_000):
        near = (np.einsum("ij,ij->i", units[i], units[j]) >= least_cosine) & (nodes[i] != nodes[j])
        found.append((i[near], j[near]))
    pairs = [np.concatenate(p) for p in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 2
    left, right = pairs
    ok = (sides[left] < 0) | (sides[left] != sides[right])
    left, right = left[ok], right[ok]
    if len(left):
        used, where = np.unique(np.concatenate((left, right)), return_inverse=True)
        row, code = filters.listed(units[used])
        order = np.argsort(row, kind="stable")
        lists = [frozenset(c.tolist()) for c in np.split(code[order], np.cumsum(np.bincount(row, minlength=len(used)))[:-1])]
        a, b = where[: len(left)].tolist(), where[len(left) :].tolist()
        mine = codes[left].tolist()
        first = np.fromiter((first_common(lists[x], lists[y], c) for x, y, c in zip(a, b, mine, strict=True)), bool, len(a))
        yield left[first], right[first]
    for start, size in zip(starts[sizes >= 64].tolist(), sizes[sizes >= 64].tolist(), strict=True):
        # a large run: tiles of a matrix product, and bit masks of the earlier directions
        rows = np.arange(start, start + size)
        row, code = filters.listed(units[rows])
        earlier = code < codes[start]
        row, code = row[earlier], code[earlier]
        kept, column, times = np.unique(code, return_inverse=True, return_counts=True)
        shared = times[column] > 1
        row, column = row[shared], np.cumsum(times > 1)[column[shared]] - 1
        masks = np.zeros((size, max(1, -(-int((times > 1).sum()) // 64))), np.uint64)
        np.bitwise_or.at(masks, (row, column // 64), np.uint64(1) << (column % 64).astype(np.uint64))
        for x in range(0, size, 1024):
            for y in range(x, size, 1024):
                a, b = rows[x : x + 1024], rows[y : y + 1024]
                near = (units[a] @ units[b].T >= least_cosine) & (nodes[a][:, None] != nodes[b][None])
                near &= (sides[a] < 0)[:, None] | (sides[a][:, None] != sides[b][None])
                if x == y:
                    near = np.triu(near, 1)
                for word in range(masks.shape[1]):
                    if not near.any():
                        break
                    near &= (masks[x : x + 1024, word][:, None] & masks[y : y + 1024, word][None]) == 0
                i, j = np.nonzero(near)
                if len(i):
                    yield a[i], b[j]


def verified(rows: DataFrame, filters: CapFilters, least_cosine: float) -> DataFrame:
    """From rows sorted by run: per node how many vectors it meets (other null), and spanning links (other set)."""

    def run(batches):
        import pyarrow as pa

        for table in whole_runs(batches, "run"):
            table = table.combine_chunks()
            units = unit_rows(table.column("vector").combine_chunks())
            node, copies, runs, side, code = (table.column(c).to_numpy() for c in ("node", "copies", "run", "side", "code"))
            # a run's hash may cover two groups: number the groups themselves
            label, cell = table.column("label").to_numpy(), table.column("cell").to_numpy()
            change = (label[1:] != label[:-1]) | (code[1:] != code[:-1]) | (cell[1:] != cell[:-1])
            groups = np.concatenate(([0], np.cumsum(change)))
            counts, lefts, rights = np.zeros(len(node), np.int64), [], []
            for i, j in met_pairs(units, node, groups, side, code, filters, least_cosine):
                np.add.at(counts, i, copies[j])
                np.add.at(counts, j, copies[i])
                left, right = spanning_links(node[i], node[j])
                lefts.append(left)
                rights.append(right)
            met = np.flatnonzero(counts)
            if len(met):
                own, where = np.unique(node[met], return_inverse=True)
                sums = np.bincount(where, weights=counts[met]).astype(np.int64)
                none = pa.nulls(len(own), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sums), none], ["node", "met", "other"])
                left, right = spanning_links(np.concatenate(lefts), np.concatenate(rights))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(left), pa.array(np.zeros(len(left), np.int64)), pa.array(right)], ["node", "met", "other"]
                )

    return rows.mapInArrow(run, "node long, met long, other long")


def near_vectors(
    vectors: DataFrame, least_cosine: float = 0.93, tables: int = 3, lists: float = 16, run_rows: int = 2048, seed: int = 5,
    most_missed: float = 0.001,
) -> DataFrame:
    """Vectors (vec_id, embedding, label) linked at a cosine of least_cosine or more within their label.

    Equal vectors of a label are one node with a count. Each node is list-decoded to all directions of a few random
    product codes whose cap holds it; the number of directions grows with the largest label, so a direction keeps some
    dozen vectors. Nodes join on (label, direction) and every meeting is verified in double precision. A pair is counted only
    under the first direction that both vectors are listed at, so counts need no list of pairs; links leave a task
    as spanning links. A direction with more than run_rows nodes is dealt over several tasks in blocks. The search misses a
    pair only if its vectors share no direction. More directions have narrower caps, so tables are added to the given number
    until at most most_missed of the pairs at exactly least_cosine are missed, fewer above (see enough_filters), whatever the
    size; each table adds `lists` copies of a vector to the shuffle. At 0.93 and 64 dimensions: 4 tables for labels of up to
    6,144 vectors, 5 for 101,400, 7 for 1.8 million.

    Returns one row per input row: vec_id, n_links (other rows linked directly), component_id (smallest vec_id
    reachable), kept. Rows with a NULL id, label or vector, a zero vector, or NULL or non-finite components link with
    nothing and are their own component (NULL for a NULL id, and kept). Vectors of different lengths do not link; all are
    filled up to the longest for the search, so a table should not hold a few that are far longer than the rest. Rows that repeat an id and vector count each; rows that share an
    id but not the vector share component_id and the sum of their links. No rows give no rows; extra columns are ignored.
    """
    vector = F.col("embedding").cast("array<float>")
    length = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & (length > 0), F.lit(False))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), vector.alias("vector"), usable.alias("usable")
    )
    # a group is a label and a length; shorter vectors are filled up with zeros, which changes no cosine within the group
    dims = rows.filter("usable").agg(F.max(F.size("vector"))).first()[0]
    if dims is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    size = F.size("vector")
    filled = F.when(size < dims, F.concat("vector", F.array_repeat(F.lit(0.0).cast("float"), dims - size))).otherwise(F.col("vector"))
    rows = rows.withColumns({"label": F.col("label") * F.lit(1 << 31) + size, "vector": F.when(F.col("usable"), filled)})
    grouped = rows.filter("usable").groupBy("label", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    nodes = staged(grouped, "vectors")
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0]
    codewords = max(64, int(np.ceil(np.sqrt(lists * largest / 24))))
    filters = enough_filters(dims, codewords, tables, lists, seed, least_cosine, most_missed)
    spread = nodes.repartition(nodes.sparkSession.sparkContext.defaultParallelism)
    crowded = listings(spread, filters, False).groupBy("label", "code").count().filter(F.col("count") > run_rows)
    crowded = staged(crowded.select("label", "code", F.ceil(F.col("count") / run_rows).cast("int").alias("pieces")), "vectors-crowded")
    listed = listings(spread, filters, True).join(crowded, ["label", "code"], "left")
    piece = F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int")
    # blocks (a, b) with a <= b: a node of piece p is in (p, b) as side 0 and in (a, p) as side 1
    other = F.posexplode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1))
    cells = listed.withColumn("piece", F.coalesce(piece, F.lit(0))).select("*", other.alias("at", "other"))
    low, high = F.least("piece", "other"), F.greatest("piece", "other")
    cells = cells.select(
        "label", "code", "node", "copies", "vector",
        (low * F.coalesce("pieces", F.lit(1)) + high).cast("long").alias("cell"),
        F.when(low == high, -1).when(F.col("piece") == low, 0).otherwise(1).alias("side"),
    )
    cells = cells.withColumn("run", F.xxhash64("label", "code", "cell"))
    cells = cells.repartition("run").sortWithinPartitions("run", "label", "code", "cell")
    met = staged(verified(cells, filters, least_cosine), "vectors-met")
    counts = met.groupBy(F.col("node").alias("_node")).agg(F.sum("met").alias("met"))
    roots = connected_components(met.filter("other IS NOT NULL").select("node", "other"))
    known = nodes.select(F.col("label").alias("_label"), F.col("vector").alias("_vector"), "node", "copies")
    known = known.join(counts, known["node"] == counts["_node"], "left").join(roots.withColumnRenamed("node", "_rooted"), F.col("node") == F.col("_rooted"), "left")
    known = known.select("_label", "_vector", (F.coalesce("met", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id"))
    same = F.col("usable") & (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector"))
    out = rows.join(known, same, "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


by_value(__name__)
