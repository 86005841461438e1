"""Near-duplicate documents by SimHash, joined on a grid of segment bit counts."""

from __future__ import annotations

import itertools
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components
from ledgerloom.llm.workers import by_value, later_in_run, run_ends, spanning_links, whole_runs
from ledgerloom.session import staged

SEGMENT_BITS = 2


def simhash(text: bytes, words: int, seed: int) -> int:
    """64-bit fingerprint of a text's word shingles; 0 without words."""
    import xxhash

    tokens = text.lower().split()  # bytes: only A-Z and only ASCII blanks
    if not tokens:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return digest(b" ".join(tokens), seed)
    line = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-words] + 1))
    spans = zip(starts.tolist(), ends[words - 1 :].tolist(), strict=True)
    hashes = np.array([digest(line[a:b], seed) for a, b in spans], dtype="<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_280):  # bytes add up to 255 at most
        bits = np.unpackbits(hashes[at : at + 65_280].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        counts += np.add.reduce(bits[:whole].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.int64)
    ones = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fingerprint (64 bits as a signed long) of every whole text, and the carried columns."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            prints = np.empty(batch.num_rows, np.uint64)
            for i, text in enumerate(batch.column("text")):
                prints[i] = simhash(text.as_buffer().to_pybytes() if text.is_valid else b"", words, seed)
            columns = [batch.column("doc_id"), pa.array(prints.view(np.int64)), *(batch.column(c) for c in carry)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fingerprint", *carry])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    carried = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return slim.mapInArrow(run, f"doc_id long, fingerprint long{carried}")


def segment_counts(prints: np.ndarray) -> np.ndarray:
    """One bits of each of the 32 segments, as rows of small integers."""
    segments = 64 // SEGMENT_BITS
    shifts = np.arange(segments, dtype=np.uint64) * np.uint64(SEGMENT_BITS)
    parts = (prints[:, None] >> shifts) & np.uint64((1 << SEGMENT_BITS) - 1)
    return np.bitwise_count(parts).astype(np.int64)


def grid_groups(rows: int, max_bits: int, meetings: int = 512, most_cells: int = 2000) -> int:
    """Into how many groups the 32 segments are cut, so that a fingerprint meets few others at any table size.

    A fingerprint lies in one cell for each choice of (groups - max_bits) groups. Random ones agree in a segment count with a
    chance of 3/8, so more groups make fewer meetings of more cells. The first number that expects at most `meetings` of
    each fingerprint is taken; `most_cells` bounds the cells of one (reached beyond 10^11 fingerprints at four bits).
    """
    segments = 64 // SEGMENT_BITS
    if not 0 <= max_bits <= segments - 2:
        raise ValueError(f"max_bits must be 0 to {segments - 2}")
    best = max_bits + 2
    for groups in range(max_bits + 2, segments + 1):
        cells, shared = math.comb(groups, max_bits), segments * (groups - max_bits) / groups
        if cells > most_cells:
            break
        best = groups
        if rows * cells * 0.375**shared <= meetings:
            break
    return best


def grid_rows(prints: DataFrame, max_bits: int, groups: int) -> DataFrame:
    """Each fingerprint in its grid cells, one for each choice of (groups - max_bits) groups of segments: cell, fingerprint."""

    def run(batches):
        import pyarrow as pa

        segments, base = 64 // SEGMENT_BITS, SEGMENT_BITS + 1
        bounds = np.linspace(0, segments, groups + 1).astype(int)
        widths = np.diff(bounds)
        choices = list(itertools.combinations(range(groups), groups - max_bits))
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("fingerprint").to_numpy()
            counts = segment_counts(own.view(np.uint64)).astype(np.uint64)
            codes = [counts[:, a:b] @ (np.uint64(base) ** np.arange(b - a, dtype=np.uint64)) for a, b in zip(bounds, bounds[1:], strict=False)]
            at_once = max(1, 200_000 // len(own))
            for at in range(0, len(choices), at_once):
                cells = []
                for number, choice in enumerate(choices[at : at + at_once], at):
                    cell = np.full(len(own), number, np.uint64)
                    for group in choice:  # may wrap around: a clash only brings more rows to verify
                        cell = cell * np.uint64(base ** int(widths[group])) + codes[group]
                    cells.append(cell.view(np.int64))
                rows = [pa.array(np.concatenate(cells)), pa.array(np.tile(own, len(cells)))]
                yield pa.RecordBatch.from_arrays(rows, ["cell", "fingerprint"])

    return prints.mapInArrow(run, "cell long, fingerprint long")


def met_links(left: np.ndarray, right: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the pairs (one of left, one of right) within max_bits."""
    highs, lows = [], []
    step = max(1, 1_000_000 // max(1, len(right)))
    for at in range(0, len(left), step):
        i, j = np.nonzero(np.bitwise_count(left[at : at + step, None] ^ right[None, :]) <= max_bits)
        high, low = spanning_links(left[at + i].view(np.int64), right[j].view(np.int64))
        highs.append(high)
        lows.append(low)
    return spanning_links(np.concatenate(highs), np.concatenate(lows)) if highs else (np.empty(0, np.int64),) * 2


def cell_links(cells: DataFrame, max_bits: int, crowd: int) -> DataFrame:
    """Links within cells of at most `crowd` rows (high, low); rows of fuller cells come out by themselves (cell, chunk, high).

    The rows of a fuller cell are numbered in chunks of `crowd` while they stream by, so no task holds a whole cell.
    """

    def run(batches):
        import pyarrow as pa

        names = ["high", "low", "cell", "chunk"]

        def settled(cells, prints, chunk, begun):
            """Batches for sorted cells. begun: the first one is known to be too full, and `chunk` chunks of it went out before."""
            ends, starts = run_ends(cells), np.searchsorted(cells, cells, side="left")
            full = (ends - starts > crowd) | ((starts == 0) & begun)
            if full.any():
                at = np.flatnonzero(full)
                number = (at - starts[at]) // crowd + np.where(starts[at] == 0, chunk, 0)
                yield pa.RecordBatch.from_arrays([pa.array(prints[at]), pa.nulls(len(at), pa.int64()), pa.array(cells[at]), pa.array(number)], names)
            bits = prints.view(np.uint64)
            highs, lows = [], []
            for i, j in later_in_run(ends, np.flatnonzero(~full)):
                near = np.bitwise_count(bits[i] ^ bits[j]) <= max_bits
                if near.any():
                    high, low = spanning_links(prints[i[near]], prints[j[near]])
                    highs.append(high)
                    lows.append(low)
            if highs:
                high, low = spanning_links(np.concatenate(highs), np.concatenate(lows))
                none = pa.nulls(len(high), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(low), none, none], names)

        kept, open_cell, gone = np.empty(0, np.int64), None, 0  # rows of the last cell so far; its chunks that went out
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, prints = batch.column("cell").to_numpy(), batch.column("fingerprint").to_numpy()
            if len(kept):
                cells, prints = np.concatenate((np.full(len(kept), open_cell), cells)), np.concatenate((kept, prints))
            if cells[0] != open_cell:
                gone = 0
            last = int(np.searchsorted(cells, cells[-1], side="left"))
            if last:
                yield from settled(cells[:last], prints[:last], gone, gone > 0)
                gone = 0
            kept, open_cell = prints[last:], cells[-1]
            whole = len(kept) // crowd * crowd if len(kept) > crowd else 0
            if whole:
                yield from settled(cells[last : last + whole], kept[:whole], gone, True)
                gone, kept = gone + whole // crowd, kept[whole:]
        if len(kept):
            yield from settled(np.full(len(kept), open_cell), kept, gone, gone > 0)

    return cells.mapInArrow(run, "high long, low long, cell long, chunk long")


def chunk_links(crowded: DataFrame, max_bits: int) -> DataFrame:
    """Links (high, low) within crowded cells (cell, chunk, high): every two chunks of a cell meet in a task of their own."""

    def run(batches):
        import pyarrow as pa

        for table in whole_runs(batches, "tile"):
            tiles, sides = table.column("tile").to_numpy(), table.column("side").to_numpy()
            prints = table.column("high").to_numpy().view(np.uint64)
            at = 0
            while at < len(tiles):
                end = int(np.searchsorted(tiles, tiles[at], side="right"))
                own, side = prints[at:end], sides[at:end]
                left, right = own[side < 2], own[side > 0]
                high, low = met_links(left, right, max_bits)
                if len(high):
                    yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(low)], ["high", "low"])
                at = end

    chunks = crowded.groupBy(F.col("cell").alias("_cell")).agg(F.max("chunk").alias("_last"))
    met = crowded.join(chunks, F.col("cell") == F.col("_cell"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "_last")))
    # side 0 meets side 2; rows of side 1 meet each other
    side = F.when(F.col("chunk") == F.col("other"), 1).when(F.col("chunk") < F.col("other"), 0).otherwise(2)
    tile = F.xxhash64("cell", F.least("chunk", "other"), F.greatest("chunk", "other"))
    met = met.select(tile.alias("tile"), side.cast("int").alias("side"), "high")
    return met.repartition("tile").sortWithinPartitions("tile", "side").mapInArrow(run, "high long, low long")


def close_links(prints: DataFrame, max_bits: int = 4, meetings: int = 512, crowd: int = 8192) -> DataFrame:
    """Links (high, low) between distinct fingerprints at max_bits or fewer differing bits, as spanning links.

    The bit counts of 2-bit segments turn a fingerprint into a point of a 32-dimensional grid, and the Manhattan
    distance of two points is at most the number of differing bits. With the segments in g groups, two points within
    max_bits are equal in at least g - max_bits groups, so they meet in the cell of that choice of groups; every meeting is verified
    by the exact bit difference in array code. g grows with the table, so that random fingerprints expect at most
    `meetings` others (grid_groups). A cell of more than `crowd` rows is cut into chunks, and every two chunks meet in a task of
    their own. Only links that join something new within a batch leave the task. prints is read twice.
    """
    groups = grid_groups(prints.count(), max_bits, meetings)
    cells = grid_rows(prints, max_bits, groups).repartition("cell").sortWithinPartitions("cell")
    met = staged(cell_links(cells, max_bits, crowd), "simhash-met")
    crowded = met.filter("chunk IS NOT NULL")
    links = met.filter("chunk IS NULL").select("high", "low")
    return links.unionByName(chunk_links(crowded.select("cell", "chunk", "high"), max_bits))


def rooted_fingerprints(docs: DataFrame, words: int, seed: int, max_bits: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, fingerprint, the carried columns, root (smallest fingerprint of the component), component_id."""
    prints = staged(fingerprints(docs, words, seed, carry), "simhash")
    nodes = staged(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    roots = connected_components(staged(close_links(nodes.select("fingerprint"), max_bits), "simhash-links"))
    rooted = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left")
    rooted = rooted.select("fingerprint", F.coalesce("root", "fingerprint").alias("root"), "first_id")
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(smallest, "root").select(F.col("fingerprint").alias("_print"), "root", "component_id")
    return prints.join(named, prints["fingerprint"] == named["_print"]).drop("_print")


def near_duplicates(docs: DataFrame, words: int = 4, seed: int = 42, max_bits: int = 4) -> DataFrame:
    """Documents (doc_id, text) whose SimHash fingerprints are linked, directly or through others.

    A text is lower-cased (A-Z), split at ASCII blanks and hashed by shingles of `words` words, repeats included (a shorter
    text is one shingle); a fingerprint bit is 1 if more than half of the hashes have it. Equal fingerprints are one
    node, so copies are never paired; distinct ones are linked by close_links and joined to components.

    Returns one row per input row: doc_id, fingerprint (16 hexadecimal digits), component_id (smallest doc_id of the
    component; NULL only where no row of it has an id). NULL, empty and blank texts have fingerprint zero and are linked as
    any other. Repeated rows share a component. No rows give no rows. Extra columns are ignored. Very long texts are
    hashed whole; a task holds one text's words at a time.
    """
    return rooted_fingerprints(docs, words, seed, max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


by_value(__name__)
