"""Token files: ids in document order, compressed by static range asymmetric numeral systems.

A file set is a folder with three Parquet tables, so Spark's committers and any shared store do the writing:
  frequencies  symbol, frequency: the one table that all blocks share; frequencies add up to 2^20
  blocks       part, block, first_token, n_tokens, and for decoding payload (32-bit words), states and offsets (the
               checkpoints), payload_crc32, ids_crc32, and for documents piece_doc, piece_order, piece_length, piece_after
A block has 65,536 ids (the last of a part fewer), dealt to 64 interleaved coder lanes. A checkpoint every 128 steps
holds the lanes' states and the payload offset, so every segment of 8,192 ids is decoded by itself and many at once.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from operator import attrgetter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.token_words import WordMemo
from ledgerloom.llm.workers import by_value, kept_in_worker
from ledgerloom.session import remove, scratch_path

SCALE_BITS, LANES, SEGMENT_STEPS, BLOCK_SEGMENTS = 20, 64, 128, 8
SEGMENT = LANES * SEGMENT_STEPS
BLOCK = SEGMENT * BLOCK_SEGMENTS
LOWEST = np.uint64(1 << 31)
BLOCKS_AT_ONCE = 32

BLOCK_SCHEMA = (
    "part int, block int, first_token long, n_tokens int, payload binary, states binary, offsets binary, payload_crc32 long, "
    "ids_crc32 long, piece_doc array<long>, piece_order array<long>, piece_length array<long>, piece_after array<long>"
)
PIECE_SCHEMA = "part int, doc_order long, doc_id long, first_token long, n_ids long"


def scaled_frequencies(counts: np.ndarray) -> np.ndarray:
    """Whole numbers in proportion to the counts that add up to 2^20, at least 1 where a count is not 0."""
    present = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if not len(present):
        return out
    room = (1 << SCALE_BITS) - len(present)
    if room < 0:
        raise ValueError("more symbols than the frequency scale has room for")
    exact = counts[present].astype(np.float64) * room / counts.sum()
    out[present] = 1 + np.floor(exact).astype(np.int64)
    out[present[counts[present].argmax()]] += (1 << SCALE_BITS) - out.sum()
    return out


class SharedTable:
    def __init__(self, frequencies: np.ndarray):
        self.frequency = frequencies.astype(np.uint64)
        self.start = (np.cumsum(frequencies) - frequencies).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(frequencies), dtype=np.uint32), frequencies)

    def encode(self, blocks: list[np.ndarray]) -> list[tuple[bytes, bytes, bytes]]:
        """(payload, states, offsets) of each block; the blocks' lanes advance together."""
        steps = max(-(-len(b) // LANES) for b in blocks)
        ids = np.zeros((len(blocks), steps * LANES), np.uint32)
        for row, block in zip(ids, blocks, strict=True):
            row[: len(block)] = block
        ids = ids.reshape(len(blocks), steps, LANES)
        sizes = np.array([len(b) for b in blocks])[:, None]
        all_active = int(sizes.min()) // LANES  # steps in which no lane is past its block's end
        state = np.full((len(blocks), LANES), LOWEST, np.uint64)
        words = np.zeros((len(blocks), steps, LANES), np.uint32)
        sent = np.zeros((len(blocks), steps, LANES), bool)
        marks = []
        room, word = np.uint64(63 - SCALE_BITS), np.uint64(32)
        for step in range(steps - 1, -1, -1):
            symbol = ids[:, step]
            frequency = self.frequency[symbol]
            active = None
            if step >= all_active:
                active = step * LANES + np.arange(LANES) < sizes
                frequency = np.where(active, frequency, np.uint64(1))
            full = state >= frequency << room
            if active is not None:
                full &= active
            words[:, step], sent[:, step] = state, full  # the lower 32 bits
            shrunk = np.where(full, state >> word, state)
            times = shrunk // frequency
            # times * 2^20 + the rest of the division + start
            coded = times * (np.uint64(1 << SCALE_BITS) - frequency) + shrunk + self.start[symbol]
            state = coded if active is None else np.where(active, coded, shrunk)
            if step % SEGMENT_STEPS == 0:
                marks.append(state)
        marks = np.stack(marks[::-1], axis=1).astype("<u8")
        out = []
        for i, block in enumerate(blocks):
            segments = -(-len(block) // SEGMENT)
            per_step = np.concatenate(([0], np.cumsum(sent[i].sum(axis=1))))
            offsets = per_step[: segments * SEGMENT_STEPS : SEGMENT_STEPS].astype("<u4")
            out.append((words[i][sent[i]].astype("<u4").tobytes(), marks[i, :segments].tobytes(), offsets.tobytes()))
        return out

    def decode(self, blocks: list[tuple[bytes, bytes, bytes, int]]) -> list[np.ndarray]:
        """Ids of blocks given as (payload, states, offsets, number of ids); all their segments advance together."""
        bases = np.cumsum([0, *(len(b[0]) // 4 for b in blocks)])
        words = np.frombuffer(b"".join(b[0] for b in blocks) + b"\0" * 4 * LANES, "<u4")
        state = np.concatenate([np.frombuffer(b[1], "<u8") for b in blocks]).reshape(-1, LANES).astype(np.uint64)
        at = np.concatenate([np.frombuffer(b[2], "<u4").astype(np.int64) + base for b, base in zip(blocks, bases, strict=False)])
        left = np.concatenate([np.minimum(SEGMENT, n - np.arange(0, n, SEGMENT)) for *_, n in blocks])[:, None]
        out = np.zeros((len(state), SEGMENT_STEPS, LANES), np.uint32)
        all_active = int(left.min()) // LANES
        for step in range(-(-int(left.max()) // LANES)):
            active = None if step < all_active else step * LANES + np.arange(LANES) < left
            slot = state & np.uint64((1 << SCALE_BITS) - 1)
            symbol = self.symbol[slot]
            out[:, step] = symbol
            back = self.frequency[symbol] * (state >> np.uint64(SCALE_BITS)) + slot - self.start[symbol]
            empty = back < LOWEST
            if active is not None:
                empty &= active
                back = np.where(active, back, state)
            state = back
            row, lane = np.nonzero(empty)  # lane by lane in each row, as the payload has them
            taken = np.bincount(row, minlength=len(at))
            nth = np.arange(len(row)) + np.repeat(at - (np.cumsum(taken) - taken), taken)
            state[row, lane] = state[row, lane] << np.uint64(32) | words[nth].astype(np.uint64)
            at = at + taken
        ends = np.cumsum([-(-n // SEGMENT) for *_, n in blocks])
        if (state[ends - 1] != LOWEST).any():
            raise ValueError("a block does not end in the coder's first state")
        return [out[e - -(-n // SEGMENT) : e].reshape(-1)[:n] for e, (*_, n) in zip(ends, blocks, strict=True)]


def byte_characters() -> dict[int, str]:
    """Byte-level vocabularies spell bytes as characters: printable ones as themselves, the n-th other one as 256 + n."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + n) for n, b in enumerate(others)}


def library_encoder(tokenizer, kind: str):
    """Strings to raw ids by the tokenizers library; an optional blank and letters, one piece, go straight to its model."""
    piece, number = tokenizer.model.tokenize, attrgetter("id")
    code = "H" if kind == "<u2" else "I"
    spelled = np.arange(256, dtype="<u2")
    for byte, character in byte_characters().items():
        spelled[byte] = ord(character)
    spelled[10] = 10  # between strings, where letters are spelled in one go

    def encode(strings: list[str]) -> list[bytes]:
        out, alone, whole = [b""] * len(strings), [], []
        for i, text in enumerate(strings):
            (alone if text[text[:1] == " " :].isalpha() else whole).append(i)
        if alone:
            read = np.frombuffer("\n".join([strings[i] for i in alone]).encode(), np.uint8)
            ids, ends = array(code), []
            for text in spelled[read].tobytes().decode("utf-16-le").split("\n"):
                ids.extend(map(number, piece(text)))
                ends.append(len(ids))
            size, raw, at = ids.itemsize, ids.tobytes(), 0
            for i, to in zip(alone, ends, strict=True):
                out[i] = raw[size * at : size * to]
                at = to
        for at in range(0, len(whole), 1000):
            some = whole[at : at + 1000]
            for i, e in zip(some, tokenizer.encode_batch_fast([strings[i] for i in some], add_special_tokens=False), strict=True):
                out[i] = array(code, e.ids).tobytes()
        return out

    return encode


def raw_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def tokenize(docs: DataFrame, tokenizer_file: str, end_id: int, kind: str) -> DataFrame:
    """doc_id and ids (raw integers, the end id behind them) of every whole text; NULL counts as empty.

    Strings of special tokens in a text are those tokens, as the library has it. The file must be a byte-level one that
    changes no text before cutting it, as words are tokenized by themselves.
    """
    with open(tokenizer_file, encoding="utf-8") as source:
        read = source.read()
    parts = json.loads(read)
    cutter = parts.get("pre_tokenizer") or {}
    plain = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
    if not plain or parts.get("normalizer"):
        raise ValueError("not a byte-level vocabulary without normalizer")
    content, named = docs.sparkSession.sparkContext.broadcast(read), (zlib.crc32(read.encode()), kind)

    def run(batches):
        import pyarrow as pa
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        # words known from a worker's earlier tasks are not tokenized again
        memo = kept_in_worker(named, lambda: WordMemo(library_encoder(Tokenizer.from_str(content.value), kind), kind))
        for batch in batches:
            for at, texts, ids, counts in memo.ids(batch.column("text")):
                ends = np.cumsum(counts)
                ended = np.insert(ids, ends, end_id).astype(kind)
                bounds = np.concatenate(([0], ends + np.arange(1, len(ends) + 1))) * ended.itemsize
                raw = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(ended)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(texts)), raw], ["doc_id", "ids"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, ids binary")


def symbol_counts(tokens: DataFrame, vocabulary: int, kind: str) -> np.ndarray:
    """How often each id occurs; what reaches the driver is one number per id of the vocabulary."""

    def run(batches):
        import pyarrow as pa

        counts = np.zeros(vocabulary, np.int64)
        for batch in batches:
            flat = np.frombuffer(b"".join(batch.column("ids").to_pylist()), kind)
            counts += np.bincount(flat, minlength=vocabulary)
        symbol = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(symbol), pa.array(counts[symbol])], ["symbol", "n"])

    rows = tokens.select("ids").mapInArrow(run, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(vocabulary, np.int64)
    for row in rows:
        counts[row["symbol"]] = row["n"]
    return counts


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str, vocabulary: int, end_id: int = 0) -> None:
    """Tokenize documents (doc_id, text) and write their ids, in ascending doc_id order, as a file set at path.

    Texts are tokenized where they are read; only ids are range-partitioned by doc_id, sorted and coded. A part of the file set
    is one range; rows of one doc_id are dealt on by a hash of their ids, so an id that a third of all rows share, or lack, fills
    several. NULL and empty texts have the end id only. NULL ids come first; repeated ids stay documents
    of their own, in the order of that hash and their token ids. An empty table gives a file set without blocks.
    """
    kind = raw_type(vocabulary)
    spark = docs.sparkSession
    scratch = scratch_path(spark, "token-ids")
    tokenize(docs, tokenizer_file, end_id, kind).write.option("compression", "zstd").parquet(scratch)
    tokens = spark.read.schema("doc_id long, ids binary").parquet(scratch)
    frequencies = scaled_frequencies(symbol_counts(tokens, vocabulary, kind))
    table = [(i, int(f)) for i, f in enumerate(frequencies) if f]
    spark.createDataFrame(table, "symbol int, frequency int").coalesce(1).write.parquet(f"{path}/frequencies")
    shared = spark.sparkContext.broadcast(frequencies)  # one number per id of the vocabulary

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, coder = TaskContext.get().partitionId(), SharedTable(shared.value)
        schema = pa.schema(
            [("part", pa.int32()), ("block", pa.int32()), ("first_token", pa.int64()), ("n_tokens", pa.int32())]
            + [(c, pa.binary()) for c in ("payload", "states", "offsets")]
            + [(c, pa.int64()) for c in ("payload_crc32", "ids_crc32")]
            + [(c, pa.list_(pa.int64())) for c in ("piece_doc", "piece_order", "piece_length", "piece_after")]
        )
        block = first = order = 0
        pending: list[tuple] = []  # (doc_id, order, ids) in order
        waiting = 0

        def cut(last: bool):
            """Rows of the next blocks; keeps what is less than a full block unless it is the last."""
            nonlocal block, first, pending, waiting
            while waiting >= BLOCK or (last and waiting):
                ids, pieces = [], []
                for _ in range(BLOCKS_AT_ONCE):
                    if waiting < (1 if last else BLOCK):
                        break
                    room, own, at = BLOCK, [], 0
                    marks = []
                    while room and at < len(pending):
                        doc, nth, rest = pending[at]
                        own.append(rest[:room])
                        marks.append((doc, nth, len(own[-1]), len(rest) - len(own[-1])))
                        room -= len(own[-1])
                        if len(own[-1]) < len(rest):
                            pending[at] = (doc, nth, rest[len(own[-1]) :])
                            break
                        at += 1
                    pending = pending[at:]
                    ids.append(np.concatenate(own))
                    pieces.append(list(zip(*marks, strict=True)))
                    waiting -= len(ids[-1])
                rows = []
                for own, (docs_of, orders, lengths, after), coded in zip(ids, pieces, coder.encode(ids), strict=True):
                    sums = zlib.crc32(coded[0]), zlib.crc32(own.astype("<u4").tobytes())
                    rows.append((part, block, first, len(own), *coded, *sums, list(docs_of), list(orders), list(lengths), list(after)))
                    block, first = block + 1, first + len(own)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                ids = np.frombuffer(raw, kind)
                pending.append((doc, order, ids))
                waiting, order = waiting + len(ids), order + 1
                if waiting >= BLOCK * BLOCKS_AT_ONCE:
                    yield from cut(False)
        yield from cut(True)

    hashed = tokens.withColumn("spread", F.xxhash64("ids"))
    ordered = hashed.repartitionByRange("doc_id", "spread").sortWithinPartitions("doc_id", "spread", "ids").drop("spread")
    ordered.mapInArrow(run, BLOCK_SCHEMA).write.parquet(f"{path}/blocks")
    remove(spark, scratch)


def read_token_files(spark: SparkSession, path: str, digests: bool = False) -> DataFrame:
    """Decoded documents in pieces, one for each block that a document lies in.

    Columns: part, doc_order (number of the document within its part), doc_id, first_token (of the piece, within the part),
    n_ids, and ids (32-bit little-endian) or, with digests, crc: what the piece's ids contribute to the crc32 of the document's.
    Blocks are decoded in parallel; a block whose checksums or final states do not fit its content raises an error.
    """
    table = spark.read.parquet(f"{path}/frequencies").collect()  # at most 2^20 rows
    frequencies = np.zeros(max((r["symbol"] for r in table), default=-1) + 1, np.int64)
    for row in table:
        frequencies[row["symbol"]] = row["frequency"]
    shared = spark.sparkContext.broadcast(frequencies)

    def run(batches):
        import pyarrow as pa

        coder = SharedTable(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCKS_AT_ONCE):
                rows = batch.slice(start, BLOCKS_AT_ONCE).to_pylist()
                if any(zlib.crc32(r["payload"]) != r["payload_crc32"] for r in rows):
                    raise ValueError("a block's payload does not have its checksum")
                decoded = coder.decode([(r["payload"], r["states"], r["offsets"], r["n_tokens"]) for r in rows])
                out, after = [], []
                for row, ids in zip(rows, decoded, strict=True):
                    raw = memoryview(ids.astype("<u4").tobytes())
                    if zlib.crc32(raw) != row["ids_crc32"]:
                        raise ValueError("a block's ids do not have their checksum")
                    lengths = np.array(row["piece_length"])
                    ends = np.cumsum(lengths)
                    for order, doc, length, end in zip(row["piece_order"], row["piece_doc"], lengths.tolist(), ends.tolist(), strict=True):
                        own = raw[4 * (end - length) : 4 * end]
                        out.append((row["part"], order, doc, row["first_token"] + end - length, length, zlib.crc32(own) if digests else bytes(own)))
                    after += row["piece_after"]
                *columns, last = zip(*out, strict=True)
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                if digests:
                    last = passed_on(np.array(last, np.uint32), 4 * np.array(after, np.int64)).astype(np.int64)
                arrays.append(pa.array(last))
                yield pa.RecordBatch.from_arrays(arrays, ["part", "doc_order", "doc_id", "first_token", "n_ids", "crc" if digests else "ids"])

    blocks = spark.read.parquet(f"{path}/blocks")
    return blocks.mapInArrow(run, PIECE_SCHEMA + (", crc long" if digests else ", ids binary"))


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """part and part_start, the number of ids in all parts before it; one row per part of the file set."""
    sizes = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))


def zeros_matrix() -> list[np.ndarray]:
    """For k = 0..63 the 32 columns of the matrix that passes a crc32 over 2^k zero bytes."""
    bit = np.zeros(32, np.uint32)
    bit[0] = 0xEDB88320
    bit[1:] = np.uint32(1) << np.arange(31, dtype=np.uint32)
    powers = []
    square = bit
    for _ in range(3):  # one bit, squared three times, is one byte
        square = through(square, square)
    powers.append(square)
    for _ in range(63):
        powers.append(through(powers[-1], powers[-1]))
    return powers


def through(matrix: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values), np.uint32)
    for i in range(32):
        out ^= np.where(values >> np.uint32(i) & np.uint32(1), matrix[i], np.uint32(0))
    return out


def passed_on(crcs: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Each crc32 as it contributes to a message that has so many more bytes."""
    out, powers = crcs.astype(np.uint32), zeros_matrix()
    for k in range(int(zeros.max(initial=0)).bit_length()):
        some = zeros >> k & 1 == 1
        out[some] = through(powers[k], out[some])
    return out


def document_checksums(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a file set, decoded: doc_id, start, n_tokens, ids_crc32 (over its ids as 32-bit little-endian integers).

    The crc32 of joined pieces is the exclusive or of each piece's, passed on over the bytes behind it, so the pieces of a long
    document need not meet.
    """
    whole = read_token_files(spark, path, digests=True).groupBy("part", "doc_order", "doc_id").agg(
        F.min("first_token").alias("first"), F.sum("n_ids").alias("n_tokens"), F.bit_xor("crc").alias("ids_crc32")
    )
    # one row per part of the file set, that is per task that wrote it
    return whole.join(F.broadcast(part_starts(spark, path)), F.col("part") == F.col("_part")).select(
        "doc_id", (F.col("part_start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )


by_value(__name__)
