"""Byte-level BPE by replaying merges over all words at once, and decoding."""

from __future__ import annotations

import base64
import heapq
import zlib
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.token_words import WordMemo
from ledgerloom.llm.workers import by_value, kept_in_worker


def read_ranks(content: str) -> list[bytes]:
    """Tokens by rank from the text of a rank file: base64 token and rank on each line."""
    pairs = [line.split() for line in content.splitlines() if line.strip()]
    tokens = [b""] * (max(int(rank) for _, rank in pairs) + 1)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class MergeReplay:
    """Encodes many words together. tokens: bytes by rank; every single byte must be a token.

    All bytes of all words are laid in one array with links to the neighbours. An inverted index holds, for each
    rank, the positions whose pair merges to it. Ranks are taken in ascending order; all positions of a rank merge
    at once, and only the pairs at their two neighbours are looked up anew and added to the index. A word in which a
    merge opens a lower rank than its own (not seen with trained vocabularies) is encoded again by itself.
    """

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.rank_of = {t: i for i, t in enumerate(tokens) if t}
        self.byte_rank = np.array([self.rank_of[bytes([b])] for b in range(256)], np.int64)
        keys, ranks = [], []
        for rank, token in enumerate(tokens):
            for cut in range(1, len(token)):
                a, b = self.rank_of.get(token[:cut]), self.rank_of.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    ranks.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.ranks = np.array(ranks, np.int64)[order]

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merged pair, -1 where the pair is no token."""
        if not len(self.keys):
            return np.full(len(left), -1, np.int64)
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], -1)

    def alone(self, word: bytes) -> list[int]:
        """One word, merge by merge: the lowest rank first, the leftmost of equals."""
        parts = [self.byte_rank[b].item() for b in word]
        while len(parts) > 1:
            ranks = self.pair_ranks(np.array(parts[:-1]), np.array(parts[1:]))
            open_ranks = np.where(ranks < 0, np.iinfo(np.int64).max, ranks)
            at = int(open_ranks.argmin())
            if ranks[at] < 0:
                break
            parts[at : at + 2] = [int(ranks[at])]
        return parts

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as raw 32-bit integers."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        token = self.byte_rank[np.frombuffer(b"".join(words), np.uint8)]
        size = len(token)
        if not size:
            return [b""] * len(words)
        word_of = np.repeat(np.arange(len(words)), lengths)
        following, previous = np.arange(1, size + 1), np.arange(-1, size - 1)
        edge = np.flatnonzero(word_of[1:] != word_of[:-1])
        following[edge], following[-1], previous[edge + 1] = -1, -1, -1
        alive, pair = np.ones(size, bool), np.full(size, -1, np.int64)
        inner = np.flatnonzero(following >= 0)
        pair[inner] = self.pair_ranks(token[inner], token[inner + 1])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(at: np.ndarray) -> None:
            ranks = pair[at]
            at, ranks = at[ranks >= 0], ranks[ranks >= 0]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for rank, group in zip(ranks[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts), strict=True):
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(heap, rank)
                index[rank].append(group)

        add(inner)
        irregular = set()
        while heap:
            rank = heapq.heappop(heap)
            at = np.concatenate(index.pop(rank))
            at = np.unique(at[(pair[at] == rank) & alive[at]])
            if not len(at):
                continue
            gone = following[at]
            chained = np.flatnonzero(gone[:-1] == at[1:]) + 1
            if len(chained):  # overlapping pairs, as in aaa: every second one, from the left
                start = np.ones(len(at), bool)
                start[chained] = False
                origin = np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - origin) % 2 == 0]
                gone = following[at]
            token[at], alive[gone], pair[gone] = rank, False, -1
            after = following[gone]
            following[at] = after
            inside = after >= 0
            previous[after[inside]] = at[inside]
            pair[at] = -1
            pair[at[inside]] = self.pair_ranks(token[at[inside]], token[after[inside]])
            before = previous[at]
            before = before[before >= 0]
            pair[before] = self.pair_ranks(token[before], token[following[before]])
            changed = np.concatenate((at[inside], before))
            lower = (pair[changed] >= 0) & (pair[changed] < rank)
            if lower.any():
                irregular.update(word_of[changed[lower]].tolist())
            add(changed)
        kept = np.flatnonzero(alive)
        ends = 4 * np.cumsum(np.bincount(word_of[kept], minlength=len(words)))
        raw, ends = token[kept].astype("<i4").tobytes(), ends.tolist()
        out = [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        for word in irregular:
            out[word] = np.array(self.alone(words[word]), "<i4").tobytes()
        return out


def piece_encoder(replay: MergeReplay, pattern: str):
    """Encodes strings: each match of the pattern is a word; all distinct words of a call are replayed together."""
    import regex

    matches = regex.compile(pattern).findall

    def encode(strings: list[str]) -> list[bytes]:
        # an optional blank and letters are one match
        pieces = [[s] if s[s[:1] == " " :].isalpha() else matches(s) for s in strings]
        distinct = list(set().union(*pieces)) if pieces else []
        ids = dict(zip(distinct, replay.encode([p.encode() for p in distinct]), strict=True))
        return [b"".join(map(ids.__getitem__, p)) for p in pieces]

    return encode


def decoder(tokens: list[bytes]):
    """Turns an Arrow list array of ids, without missing lists, into the bytes that they stand for."""
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    starts, table = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(tokens), np.uint8)

    def decode(flat: np.ndarray, bounds: np.ndarray):
        import pyarrow as pa

        each = lengths[flat]
        ends = np.concatenate(([0], np.cumsum(each)))
        kind = np.int32 if ends[-1] < 1 << 30 else np.int64
        content = table[np.arange(ends[-1], dtype=kind) + np.repeat((starts[flat] - ends[:-1]).astype(kind), each)]
        offsets = pa.py_buffer(ends[bounds].astype(np.int64))
        return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(content)]).cast(pa.binary())

    return decode


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, decoded: bool = False) -> DataFrame:
    """Token ids of every whole text: doc_id, ids (array of int), one row per input row, nothing shuffled.

    With decoded, also content, the bytes that the ids stand for, in the same step (see decode_documents).

    Tasks take some megabytes of documents at a time as their corpus; all words that it brings anew are replayed together.
    NULL and empty texts have no ids. Ids and repeated rows are carried as they are; extra columns are ignored; no
    rows give no rows. Special tokens are ordinary text. The vocabulary (its size does not depend on the data) is
    read by the driver and sent with the tasks.
    """
    read = Path(rank_file).read_text()
    content, named = docs.sparkSession.sparkContext.broadcast(read), (zlib.crc32(read.encode()), "replay")

    def run(batches):
        import pyarrow as pa

        replay = kept_in_worker(named, lambda: MergeReplay(read_ranks(content.value)))
        memo, decode = WordMemo(piece_encoder(replay, pattern), "<i4"), decoder(replay.tokens)
        for batch in batches:
            for at, texts, flat, counts in memo.ids(batch.column("text")):
                ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                columns = [batch.column("doc_id").slice(at, len(texts)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
                if decoded:
                    columns.append(decode(flat, ends))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "content"][: len(columns)])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, ids array<int>" + (", content binary" if decoded else ""))


def decode_documents(encoded: DataFrame, rank_file: str) -> DataFrame:
    """Adds content, the bytes that the ids stand for, to doc_id and ids. NULL ids give no bytes."""
    content = encoded.sparkSession.sparkContext.broadcast(Path(rank_file).read_text())

    def run(batches):
        import pyarrow as pa

        decode = decoder(read_ranks(content.value))
        for batch in batches:
            ids = batch.column("ids")
            lengths = ids.value_lengths().fill_null(0).to_numpy()
            flat = ids.flatten().to_numpy(zero_copy_only=False)  # leaves missing lists out
            bounds = np.concatenate(([0], np.cumsum(lengths)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, decode(flat, bounds)], ["doc_id", "ids", "content"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, content binary")


by_value(__name__)
