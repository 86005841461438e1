"""Exact top-k inner products over a bit-sliced index.

The index holds vectors, quantised to whole numbers, in blocks of some thousand rows: for each component and each bit of its
values a bitmap over the block's rows. A query adds these bitmaps, shifted as the bits of its own components say, by full adders:
the result is the rows' scores, again as bit slices. The lowest slices are left out of the sums, which bounds what a
score may lack. Top rows are taken from the most significant slice downward; rows that the missing part may lift to the k-th
place or above are boundary rows, and their scores are computed exactly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.workers import by_value
from ledgerloom.session import scratch_path

#: Rows of an index block; weights of bit sums that only exact scores see; query chunks that one task takes to a block.
BLOCK_ROWS, COARSE_BITS, CHUNKS_EACH = 16_384, 6, 64
#: Quantised components are held within these limits, so that scores of up to 2^20 components fit a long.
LARGEST = 1 << 21

INDEX_SCHEMA = "block long, length int, ids binary, known binary, lows binary, widths binary, slices binary, slots binary, asked_ids binary, asked binary"
HIT_SCHEMA = "asked_block long, asked_slot int, query_id long, vec_id long, score long"


def quantised(vectors, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """For an Arrow list column: lengths, -1 for a vector that takes no part, and floor(scale * x) of the others, laid end to end."""
    lengths = np.diff(vectors.offsets.to_numpy()).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    missing = vectors.is_null().to_numpy(zero_copy_only=False)
    lengths[missing] = 0  # flatten() leaves a missing list out
    ends = np.cumsum(lengths)
    odd = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    bad = missing | (odd[ends] > odd[ends - lengths])
    flat = flat[np.repeat(~bad, lengths)]
    numbers = np.clip(np.floor(flat * scale), -LARGEST, LARGEST).astype(np.int32)
    lengths[bad] = -1
    return lengths, numbers


def to_slices(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lowest value and bit width of each component, and the bit slices of what is above the lowest, 64 rows a word."""
    n, length = rows.shape
    lows = rows.min(axis=0).astype(np.int64) if n else np.zeros(length, np.int64)
    above = rows - lows
    widths = np.array([int(x).bit_length() for x in above.max(axis=0)], np.int64)
    slices = np.zeros((int(widths.sum()), -(-n // 64)), np.uint64)
    at = 0
    for j, width in enumerate(widths.tolist()):
        for bit in range(width):
            packed = np.packbits((above[:, j] >> bit & 1).astype(bool), bitorder="little")
            slices[at].view(np.uint8)[: len(packed)] = packed
            at += 1
    return lows, widths, slices


def add_slices(columns: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Bit slices of a sum of bitmaps. columns[w]: stacks of bitmaps that each count 2^w. Three of a weight become one and a carry."""
    out, width = [], next(x.shape[1] for stacks in columns for x in stacks)
    columns = [list(c) for c in columns]
    at = 0
    while at < len(columns):
        stack = np.concatenate(columns[at]) if columns[at] else np.zeros((1, width), np.uint64)
        while len(stack) > 1:
            third = len(stack) // 3
            if third:
                a, b, c = stack[:third], stack[third : 2 * third], stack[2 * third : 3 * third]
                differ = a ^ b
                carry = (a & b) | (differ & c)
                stack = np.concatenate((differ ^ c, stack[3 * third :]))
            else:
                carry, stack = stack[:1] & stack[1:], stack[:1] ^ stack[1:]
            if at + 1 == len(columns):
                columns.append([])
            columns[at + 1].append(carry)
        out.append(stack[0])
        at += 1
    return out


def signed_digits(q: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Each whole number as a sum of few signed powers of two: (power, components, whether negative)."""
    out, q, power = [], q.astype(np.int64), 0
    while q.any():
        odd = q & 1 == 1
        digit = np.where(odd, 2 - (q & 3), 0)
        at = np.flatnonzero(digit)
        if len(at):
            out.append((power, at, digit[at] < 0))
        q = (q - digit) >> 1
        power += 1
    return out


class Block:
    """An index block at work. order: the block's rows are sorted by id, so the first of equal rows come first."""

    def __init__(self, row: dict):
        self.block = row["block"]
        self.ids, self.known = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], bool)
        self.lows, self.widths = np.frombuffer(row["lows"], np.int64), np.frombuffer(row["widths"], np.int64)
        n, length = len(self.ids), len(self.lows)
        slices = np.frombuffer(row["slices"], np.uint64).reshape(int(self.widths.sum()), -(-n // 64))
        self.first = np.cumsum(self.widths) - self.widths
        self.everyone = np.zeros(-(-n // 64), np.uint64)
        packed = np.packbits(np.ones(n, bool), bitorder="little")
        self.everyone.view(np.uint8)[: len(packed)] = packed
        self.both = np.concatenate((slices, ~slices)) if len(slices) else slices
        self.rows = np.zeros((n, length), np.int64)
        for j in range(length):
            for bit in range(int(self.widths[j])):
                ones = np.unpackbits(slices[self.first[j] + bit].view(np.uint8), count=n, bitorder="little")
                self.rows[:, j] += ones.astype(np.int64) << bit
        self.rows += self.lows

    def coarse(self, q: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the sum from weight 2^COARSE_BITS on, and by how much the whole sum can be above (never below).

        A negative digit adds the complement of a component's slices: a constant apart, that is the same for all rows.
        """
        columns: list[list[np.ndarray]] = []
        lacking, n_slices = 0, len(self.both) // 2
        for power, at, negative in signed_digits(q):
            for bit in range(int(self.widths[at].max(initial=0))):
                some = self.widths[at] > bit
                weight, n = power + bit, int(some.sum())
                if weight < COARSE_BITS:
                    lacking += n << weight
                    continue
                index = self.first[at[some]] + bit + np.where(negative[some], n_slices, 0)
                while len(columns) <= weight - COARSE_BITS:
                    columns.append([])
                columns[weight - COARSE_BITS].append(self.both[index])
        if not columns:
            return [], lacking
        return add_slices(columns), lacking

    def best(self, q: np.ndarray, k: int, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best rows for a query, ties to earlier rows; own: the query's row, if it is here."""
        slices, lacking = self.coarse(q)
        among = self.everyone.copy()
        if own is not None:
            among[own >> 6] &= ~(np.uint64(1) << np.uint64(own & 63))
        sure, rest, threshold = np.zeros_like(among), among.copy(), 0
        for nth in range(len(slices) - 1, -1, -1):
            ones = rest & slices[nth]
            n = int(np.bitwise_count(sure | ones).sum())
            if n >= k:
                rest, threshold = ones, threshold | 1 << nth
            else:
                sure, rest = sure | ones, rest & ~slices[nth]
        # the k-th best coarse sum is the threshold; what lies lower by less than may be lacking is on the boundary
        floor = max(0, threshold - (-(-lacking >> COARSE_BITS) if lacking else 0))
        rows = np.flatnonzero(np.unpackbits(self.at_least(slices, floor, among).view(np.uint8), count=len(self.ids), bitorder="little"))
        scores = self.rows[rows] @ q
        top = np.argsort(-scores, kind="stable")[:k]
        return rows[top], scores[top]

    @staticmethod
    def at_least(slices: list[np.ndarray], floor: int, among: np.ndarray) -> np.ndarray:
        """Rows whose sliced number is not below the floor."""
        above, equal = np.zeros_like(among), among
        for nth in range(len(slices) - 1, -1, -1):
            if floor >> nth & 1:
                equal = equal & slices[nth]
            else:
                above, equal = above | (equal & slices[nth]), equal & ~slices[nth]
        return above | equal


def index_blocks(vectors: DataFrame, asked: Column, scale: float, block_rows: int) -> DataFrame:
    """Index blocks, and in each the queries among its rows: their slots and quantised components."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        held: dict[int, list[tuple]] = {}
        for batch in batches:
            lengths, numbers = quantised(batch.column("embedding"), scale)
            ids, asks = batch.column("vec_id"), batch.column("asked").fill_null(False).to_numpy(zero_copy_only=False)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            of = np.repeat(lengths, np.maximum(lengths, 0))
            for length in np.unique(lengths[lengths >= 0]).tolist():
                some = lengths == length
                held.setdefault(length, []).append((ids[some], known[some], asks[some], numbers[of == length].reshape(int(some.sum()), length)))
        schema = pa.schema([("block", pa.int64()), ("length", pa.int32())] + [(c.split()[0], pa.binary()) for c in INDEX_SCHEMA.split(", ")[2:]])
        block = TaskContext.get().partitionId() << 32
        for length, parts in held.items():
            ids, known, asks, rows = (np.concatenate(x) for x in zip(*parts, strict=True))
            by = np.lexsort((ids, ~known))  # missing ids last
            ids, known, asks, rows = ids[by], known[by], asks[by], rows[by]
            for at in range(0, len(ids), block_rows):
                own = slice(at, at + block_rows)
                slots = np.flatnonzero(asks[own]).astype(np.int32)
                lows, widths, slices = to_slices(rows[own])
                parts = [ids[own], known[own], lows, widths, slices, slots, ids[own][slots], rows[own][slots].astype(np.int32)]
                values = [block, length, *(np.ascontiguousarray(x).tobytes() for x in parts)]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)
                block += 1

    slim = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), asked.alias("asked"))
    blocks = max(1, -(-slim.count() // block_rows))
    return slim.repartition(blocks).mapInArrow(run, INDEX_SCHEMA)


def top_products(vectors: DataFrame, asked: Column, k: int, scale: float = 256.0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The k rows with the largest inner product for each query row: query_id, rank (from 1), vec_id, score; ties to smaller vec_id.

    vectors: vec_id, embedding. asked: a condition on its columns that tells which rows are queries; candidates are
    all rows but the query's own. Components x count as floor(scale * x), held within 2^21 either way. Vectors that are NULL or hold
    NULL or non-finite components take no part; vectors of other lengths than the query's are no candidates; empty
    vectors score 0 with each other. Rows without id may be found, after those with one among ties, and repeated rows are
    rows of their own, as queries too. Fewer candidates than k give them all; no rows or no queries give no rows. Extra columns
    are ignored.

    Every query meets every block once: chunks of queries (those of one block) and blocks are dealt to a grid of groups, each with
    a few blocks and at most some 64 chunks, so no task grows with the table. Each block gives at most k rows for a query.
    """
    spark = vectors.sparkSession
    path = scratch_path(spark, "bit-sliced")
    index_blocks(vectors, asked, scale, block_rows).write.parquet(path)
    index = spark.read.schema(INDEX_SCHEMA).parquet(path)
    blocks = max(1, index.count())
    shares = -(-blocks // CHUNKS_EACH)

    def dealt(seed: int, most: int) -> Column:
        return F.pmod(F.xxhash64("block", F.lit(seed)), F.lit(most)).cast("int")

    def every(most: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(most - 1)))

    targets = index.select("block", "length", "ids", "known", "lows", "widths", "slices")
    targets = targets.withColumns({"place": dealt(1, blocks), "share": every(shares)})
    # read anew: the two sides of a cogroup must not share columns
    index = spark.read.schema(INDEX_SCHEMA).parquet(path)
    chunks = index.filter(F.length("slots") > 0).select("block", "length", "slots", "asked_ids", "asked")
    chunks = chunks.withColumns({"share": dealt(2, shares), "place": every(blocks)})
    key = ["length", "place", "share"]
    tasks = min(blocks * shares, 10_000)

    def run(chunks, targets):
        import pyarrow as pa

        found = []
        for row in targets.to_pylist():
            block = Block(row)
            for chunk in chunks.to_pylist():
                slots = np.frombuffer(chunk["slots"], np.int32)
                queries = np.frombuffer(chunk["asked"], np.int32).reshape(len(slots), chunk["length"]).astype(np.int64)
                ids = np.frombuffer(chunk["asked_ids"], np.int64)
                for slot, query_id, q in zip(slots.tolist(), ids.tolist(), queries, strict=True):
                    rows, scores = block.best(q, k, slot if chunk["block"] == block.block else None)
                    n = len(rows)
                    found.append((np.full(n, chunk["block"]), np.full(n, slot, np.int32), np.full(n, query_id), block.ids[rows], block.known[rows], scores))
        names = [part.split()[0] for part in HIT_SCHEMA.split(", ")]
        if not found:
            return pa.table({n: pa.array([], pa.int32() if n == "asked_slot" else pa.int64()) for n in names})
        asked_block, slot, query_id, vec_id, known, score = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table([pa.array(asked_block), pa.array(slot), pa.array(query_id), pa.array(vec_id, mask=~known), pa.array(score)], names=names)

    hits = (
        chunks.repartition(tasks, *key).groupBy(*key).cogroup(targets.repartition(tasks, *key).groupBy(*key)).applyInArrow(run, HIT_SCHEMA)
    )
    place = Window.partitionBy("asked_block", "asked_slot").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = hits.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


by_value(__name__)
