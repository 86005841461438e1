"""Alignment of two tokenizers over a corpus: groups between common token ends, links within groups, counts of linked pairs.

Two passes. The first tokenizes and aligns where texts are read, some megabytes (a slice) at a time, and stages one row per
document with its linked pairs as numbers of the slice's own dictionary, and one row per slice with that dictionary. Pairs of
all slices are summed by Spark, joined back to the dictionaries (a row per pair and slice, not per link), and in the second pass
each slice's documents meet their dictionary with the counts of the whole corpus.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain, compress, pairwise
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.token_files import byte_characters
from ledgerloom.llm.token_words import slices_by_size
from ledgerloom.llm.workers import by_value
from ledgerloom.session import scratch_path

SLICE_BYTES, MEMO_PIECES = 12_000_000, 400_000
BLANK = "▁"

FIRST_SCHEMA = (
    "slice long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, times binary, "
    "dictionary binary, totals binary"
)
RESULT_SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


class Aligner:
    """Both vocabularies' token bytes, and the alignment of texts. A text is read behind one blank by both."""

    def __init__(self, tokenizer_json: str, model_proto: bytes):
        import pyarrow as pa
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(tokenizer_json)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = SentencePieceProcessor(model_proto=model_proto)
        byte_of = {c: b for b, c in byte_characters().items()} | {c: ord(c) for c in map(chr, range(256)) if ord(c) not in byte_characters()}
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            plain = all(c in byte_of for c in entry)
            self.bytes_a[i] = bytes(byte_of[c] for c in entry) if plain else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace(BLANK, " ").encode() for p in pieces
        ]
        self.length_a, self.length_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        # how an id is written in a group's text: within its side, and last of it
        sides = ((self.bytes_a, ",|"), (self.bytes_b, ",;"))
        self.written = pa.array([f"{i}{mark}" for side, marks in sides for mark in marks for i in range(len(side))], pa.large_string())
        # texts may be cut before a blank only if no piece reaches over one, and at a line break if no piece holds one
        over = any(BLANK in p.lstrip(BLANK) or "\n" in p for p in pieces)
        level = json.loads(tokenizer_json)
        cuttable = (level.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and level["pre_tokenizer"].get("use_regex", True)
        self.cuts = bool(cuttable) and level.get("normalizer") is None and not over

    def ids(self, texts: list[str]):
        """Ids of both for each text, read behind one blank."""
        encoded = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in encoded], self.b.encode(texts, num_threads=1)

    def pieces(self, texts: list[str]) -> list[tuple | None]:
        """Alignments of pieces: words, behind a blank, or lines behind a line break; None where bytes differ."""
        behind_line = [t[0] == "\n" for t in texts]
        contents = [t.encode() if line else b" " + t.encode() for t, line in zip(texts, behind_line, strict=True)]
        marked = [t if line else " " + t for t, line in zip(texts, behind_line, strict=True)]
        ids_a = [e.ids for e in self.a.encode_batch_fast(marked, add_special_tokens=False)]
        ids_b = self.b.encode(texts, num_threads=1)
        for i, line in enumerate(behind_line):
            if line:  # the blank before the line break is a token of its own
                ids_b[i] = ids_b[i][1:] if self.bytes_b[ids_b[i][0]] == b" " else []
        return self.align(contents, ids_a, ids_b)

    def align(self, contents: list[bytes], ids_a: list[list[int]], ids_b: list[list[int]]) -> list[tuple | None]:
        """For each content (n_a, n_b, n_groups, groups as text, each with ';' behind it, and linked pairs a * 2^32 + b as raw integers).

        None where tokens' bytes are not the content's. All contents are laid end to end, as are their tokens.
        """
        bytes_a, bytes_b = self.bytes_a, self.bytes_b
        same = [
            b"".join([bytes_a[i] for i in a]) == content and b"".join([bytes_b[i] for i in b]) == content
            for content, a, b in zip(contents, ids_a, ids_b, strict=True)
        ]
        ids_a, ids_b = (list(compress(ids, same)) for ids in (ids_a, ids_b))
        of_a, of_b = (np.concatenate(([0], np.cumsum([len(x) for x in ids], dtype=np.int64))) for ids in (ids_a, ids_b))
        flat_a, flat_b = (np.fromiter(chain.from_iterable(ids), np.int64, n[-1]) for ids, n in ((ids_a, of_a), (ids_b, of_b)))
        if not len(flat_a):
            return [None] * len(contents)
        ends_a, ends_b = np.cumsum(self.length_a[flat_a]), np.cumsum(self.length_b[flat_b])
        until, since = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)  # the other side's token that holds an end
        last_a, last_b = ends_b[until] == ends_a, ends_a[since] == ends_b
        # a token overlaps the other side's from the one behind the end before it up to the one that holds its own end
        begin = np.concatenate(([0], (until + last_a)[:-1]))
        each = until - begin + 1
        behind = np.cumsum(each)
        links = np.repeat(flat_a << 32, each) | flat_b[np.arange(behind[-1]) + np.repeat(begin - behind + each, each)]
        # groups in order, in each the tokens of a before those of b
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        upto_a, upto_b = (np.concatenate(([0], np.flatnonzero(last) + 1)) for last in (last_a, last_b))
        codes = np.empty(len(flat_a) + len(flat_b), np.int64)
        n_a, n_b = len(bytes_a), len(bytes_b)
        codes[np.arange(len(flat_a)) + upto_b[group_a]] = flat_a + n_a * last_a
        codes[np.arange(len(flat_b)) + upto_a[group_b + 1]] = flat_b + 2 * n_a + n_b * last_b
        text = self.written.take(codes)
        _, offsets, written = text.buffers()
        written = memoryview(written)
        cuts = np.frombuffer(offsets, np.int64)[of_a + of_b].tolist()
        n_groups = np.diff(np.concatenate(([0], np.cumsum(last_a)))[of_a]).tolist()
        at = (8 * np.concatenate(([0], behind))[of_a]).tolist()
        raw = links.tobytes()
        found = iter(
            zip(
                np.diff(of_a).tolist(),
                np.diff(of_b).tolist(),
                n_groups,
                [bytes(written[x:y]) for x, y in pairwise(cuts)],
                [raw[x:y] for x, y in pairwise(at)],
                strict=True,
            )
        )
        return [next(found) if x else None for x in same]


class PieceMemo:
    """Cuts texts where both tokenizers may be cut, and aligns each distinct piece once."""

    def __init__(self, aligner: Aligner):
        self.aligner, self.known = aligner, {}

    @staticmethod
    def lines(word: str) -> list[str]:
        """A word and, behind line breaks, its lines, each with its line break; the word alone where it is not to be cut."""
        first, *rest = word.split("\n")
        if any(not line or line[0].isspace() or line[-1].isspace() for line in (first, *rest)):
            return [word]
        return [first, *("\n" + line for line in rest)]

    def of(self, texts):
        """(alignments, for each text of an Arrow column without NULLs the array of their numbers or None where it has no tokens).

        A cut is right before a single blank or line break between two characters that are not white space; a text with any
        other blank is aligned as a whole.
        """
        import pyarrow.compute as pc

        if len(self.known) > MEMO_PIECES:
            self.known = {}
        split = pc.split_pattern(texts, pattern=" ")
        first = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        pieces, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if self.aligner.cuts:
            void = np.fromiter((not w or w[0].isspace() or w[-1].isspace() for w in pieces), bool, len(pieces))
            whole = np.logical_or.reduceat(void[codes], first[:-1])
        else:
            whole = np.ones(len(texts), bool)
        used = np.zeros(len(pieces), bool)
        used[codes[np.repeat(~whole, np.diff(first))]] = True
        # words with line breaks are several pieces
        number, spans = {}, {}
        for i in np.flatnonzero(used).tolist():
            if "\n" in pieces[i]:
                cut = self.lines(pieces[i])
                if len(cut) > 1:
                    used[i] = False
                    spans[i] = [number.setdefault(x, len(pieces) + len(number)) for x in cut]
        own = list(compress(pieces, used)) + list(number)
        fresh = [p for p in dict.fromkeys(own) if p not in self.known]
        for at in range(0, len(fresh), 10_000):
            some = fresh[at : at + 10_000]
            self.known.update(zip(some, self.aligner.pieces(some), strict=True))
        # numbers of words and lines among the alignments
        alignments, place = [self.known[p] for p in own], np.full(len(pieces) + len(number), -1)
        place[np.flatnonzero(used)], place[len(pieces) :] = np.arange(used.sum()), np.arange(used.sum(), len(own))
        broken = np.zeros(len(pieces), bool)
        broken[list(spans)] = True
        out = []
        for i, (at, to) in enumerate(pairwise(first.tolist())):
            if whole[i]:  # one at a time: such a text may be long
                text = texts[i].as_py()
                out.append(np.array([len(alignments)]) if text else None)
                if text:
                    alignments += self.aligner.align([(" " + text).encode()], *self.aligner.ids([text]))
                continue
            some = codes[at:to]
            if broken[some].any():
                some = np.array([x for c in some.tolist() for x in spans.get(c, (c,))])
            out.append(place[some])
        failed = np.fromiter((a is None for a in alignments), bool, len(alignments))
        return alignments, [None if c is None or failed[c].any() else c for c in out]


def aligned_slices(docs: DataFrame, tokenizer_file: str, model_file: str, digests: bool) -> DataFrame:
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast((Path(tokenizer_file).read_text(encoding="utf-8"), Path(model_file).read_bytes()))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        memo, nth = PieceMemo(Aligner(*content.value)), TaskContext.get().partitionId() << 32
        names = [part.split()[0] for part in FIRST_SCHEMA.split(", ")]
        kinds = [pa.int64()] * 6 + [pa.string()] + [pa.binary()] * 4
        for batch in batches:
            for at, some in slices_by_size(batch.column("text").fill_null(""), SLICE_BYTES):
                rows = slice_rows(memo, nth, batch.column("doc_id").slice(at, len(some)).to_pylist(), some, digests)
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
                nth += 1

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, FIRST_SCHEMA)


def slice_rows(memo: PieceMemo, nth: int, doc_ids: list, texts, digests: bool) -> list[tuple]:
    """A row for each document of a slice, and one for its dictionary of linked pairs."""
    alignments, codes = memo.of(texts)
    usable = [a or (0, 0, 0, b"", b"") for a in alignments]
    sizes = np.array([(x[0], x[1], x[2], len(x[4]) // 8) for x in usable], np.int64).reshape(-1, 4)
    flat = np.frombuffer(b"".join([x[4] for x in usable]), np.int64)
    dictionary, coded = np.unique(flat, return_inverse=True)
    coded, first = coded.astype(np.int32), np.cumsum(sizes[:, 3]) - sizes[:, 3]
    group_text = [x[3] for x in usable]
    totals = np.zeros(len(dictionary), np.int64)
    rows = []
    for doc_id, at in zip(doc_ids, codes, strict=True):
        if at is None:
            rows.append((nth, doc_id, 0, 0, 0, 0, "", b"", b"", None, None))
            continue
        n_a, n_b, n_groups, n_links = sizes[at].sum(axis=0).tolist()
        each = sizes[at, 3]
        behind = np.cumsum(each)
        links = coded[np.arange(behind[-1]) + np.repeat(first[at] - behind + each, each)]
        pairs, times = np.unique(links, return_counts=True)
        totals[pairs] += times
        groups = b"".join([group_text[i] for i in at.tolist()])[:-1]
        groups = hashlib.sha256(groups).hexdigest() if digests else groups.decode()
        rows.append((nth, doc_id, n_a, n_b, n_groups, n_links, groups, pairs.tobytes(), times.astype(np.int32).tobytes(), None, None))
    rows.append((nth, None, 0, 0, 0, 0, None, None, None, dictionary.tobytes(), totals.tobytes()))
    return rows


def dictionary_rows(staged: DataFrame) -> DataFrame:
    """One row per slice and pair: slice, code, a, b, n (links of the slice)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for nth, pairs, totals in zip(*(batch.column(c).to_pylist() for c in ("slice", "dictionary", "totals")), strict=True):
                pairs = np.frombuffer(pairs, np.int64)
                columns = [np.full(len(pairs), nth), np.arange(len(pairs), dtype=np.int32), pairs >> 32, pairs & 0xFFFFFFFF, np.frombuffer(totals, np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["slice", "code", "a", "b", "n"])

    rows = staged.filter(F.col("dictionary").isNotNull()).select("slice", "dictionary", "totals")
    return rows.mapInArrow(run, "slice long, code int, a long, b long, n long")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """a, b, links of the whole corpus that hold the pair, and whether no other a has more with this b.

    Sums are made per slice before the shuffle; a b has at most as many rows as vocabulary a has entries.
    """
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("links"))
    highest = counts.groupBy(F.col("b").alias("_b")).agg(F.max("links").alias("_most"))
    joined = counts.join(highest, F.col("b") == F.col("_b"))
    return joined.select("a", "b", "links", (F.col("links") == F.col("_most")).alias("best"))


def align_tokenizers(docs: DataFrame, tokenizer_file: str, model_file: str, digests: bool = False) -> DataFrame:
    """Per document (doc_id, text): n_a, n_b, n_groups, n_links, n_best, count_sum and groups, `a1,a2|b1;a3|b2,b3`.

    tokenizer_file: a byte-level vocabulary of the tokenizers library (a), given the text behind one blank; model_file: one of
    sentencepiece (b), which adds the blank itself. Both run without special tokens. A text has tokens only if both
    sides' bytes, joined, are the blank and the text. Ends that both have cut the tokens into groups; links are the pairs of
    tokens whose bytes overlap. A pair's count is the number of links of the corpus with its ids; count_sum adds the counts over a
    document's links, n_best counts links whose count is the highest of their b id, ties included. With digests, groups is the
    SHA-256 of that text; a document without tokens has '' either way.

    One row per input row: NULL and empty texts, and texts that b changes, have zeros. Missing and repeated ids are carried, and
    repeated rows each count. Extra columns are ignored; no rows give no rows. A long text is a slice by itself.
    The vocabularies, whose size does not depend on the data, are read by the driver and sent to the tasks.
    """
    spark = docs.sparkSession
    scratch = scratch_path(spark, "aligned")
    aligned_slices(docs, tokenizer_file, model_file, digests).write.option("compression", "zstd").parquet(scratch)
    staged = spark.read.schema(FIRST_SCHEMA).parquet(scratch)
    counted = scratch_path(spark, "aligned-pairs")
    pairs = dictionary_rows(staged)
    counts = pair_counts(pairs).select(F.col("a").alias("_a"), F.col("b").alias("_b"), "links", "best")
    with_counts = pairs.join(counts, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")))
    with_counts.select("slice", "code", "links", "best").write.option("compression", "zstd").parquet(counted)

    def run(documents, pairs):
        import pyarrow as pa

        code = pairs.column("code").to_numpy()
        links, best = np.zeros(len(code), np.int64), np.zeros(len(code), bool)
        links[code], best[code] = pairs.column("links").to_numpy(), pairs.column("best").to_numpy(zero_copy_only=False)
        n_best, count_sum = [], []
        for own, times in zip(documents.column("pairs").to_pylist(), documents.column("times").to_pylist(), strict=True):
            own, times = np.frombuffer(own, np.int32), np.frombuffer(times, np.int32).astype(np.int64)
            n_best.append(int(times[best[own]].sum()))
            count_sum.append(int(times @ links[own]))
        kept = documents.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        for name, values in (("n_best", n_best), ("count_sum", count_sum)):
            kept = kept.append_column(name, pa.array(values, pa.int64()))
        return kept.append_column("groups", documents.column("groups"))

    # a slice's documents and its dictionary, both bounded by the slice's bytes, meet in one task
    documents = staged.filter(F.col("dictionary").isNull()).drop("dictionary", "totals")
    slices = spark.read.schema("slice long, code int, links long, best boolean").parquet(counted)
    return documents.groupBy("slice").cogroup(slices.groupBy("slice")).applyInArrow(run, RESULT_SCHEMA)


by_value(__name__)
