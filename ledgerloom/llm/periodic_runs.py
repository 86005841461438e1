"""Maximal periodic stretches of words, found by internal pattern matching, and texts with the repeats taken out.

A run with period q holds an aligned dyadic block of words in its first period, and the block again q words on. So each block
asks for its occurrences in the neighbouring windows only: a range of the suffix array holds all of them, and a wavelet
matrix over the suffix array gives the smallest one at or behind a place. Occurrences that are close form a
progression; it is told from its first two. Distances are candidate periods, and a candidate is extended to both sides as
far as words stay equal, which verifies it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.token_words import slices_by_size
from ledgerloom.llm.workers import by_value

#: Every run is told by blocks of at least four words, as runs of twelve words hold one in their first period or behind it.
LEAST_RUN, LEAST_BLOCK = 12, 4

RESULT_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class SuffixOrder:
    """Suffixes of many word sequences, sequence by sequence, with the order of their first 2^k words for each k.

    ranks[k][i] is where, in suffix order, those suffixes begin that share their first 2^k words with suffix i (all within one
    sequence; a sequence's end is a word of its own). Only suffixes that still share a rank are ordered further.
    """

    def __init__(self, words: np.ndarray, sequence: np.ndarray, starts: np.ndarray):
        n = len(words)
        self.size, self.begin = n, starts[sequence]
        end = np.append(starts[1:], n)[sequence]
        order = np.argsort(sequence * (int(words.max()) + 1) + words, kind="stable")
        change = np.ones(n, bool)
        change[1:] = (words[order[1:]] != words[order[:-1]]) | (sequence[order[1:]] != sequence[order[:-1]])
        rank = np.full(n + 1, -1, np.int32)  # the last one stands for what lies behind everything
        rank[order] = np.maximum.accumulate(np.where(change, np.arange(n), 0))
        self.ranks, self.order = [rank], order
        shared = self.shared(rank)
        while len(shared):
            step = 1 << (len(self.ranks) - 1)
            at = shared + step
            behind = np.where(at < end[shared], rank[np.minimum(at, n)], -1).astype(np.int64)
            key = rank[shared].astype(np.int64) * (n + 1) + behind + 1
            by = np.argsort(key, kind="stable")
            shared, key = shared[by], key[by]
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            group = np.ones(len(key), bool)
            group[1:] = rank[shared[1:]] != rank[shared[:-1]]
            nth = np.arange(len(key))
            inside = np.maximum.accumulate(np.where(first, nth, 0)) - np.maximum.accumulate(np.where(group, nth, 0))
            finer = rank.copy()
            finer[shared] = rank[shared] + inside.astype(np.int32)
            place = rank[shared] + nth - np.maximum.accumulate(np.where(group, nth, 0))
            self.order[place] = shared
            self.ranks.append(finer)
            rank = finer
            shared = self.shared(rank)

    def shared(self, rank: np.ndarray) -> np.ndarray:
        """Places whose rank another one has too."""
        return np.flatnonzero(np.bincount(rank[:-1], minlength=self.size)[rank[:-1]] > 1)

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a and b on are equal; a < b."""
        a, b, n = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            same = np.flatnonzero(self.ranks[k][a] == self.ranks[k][b])
            same = same[b[same] < self.size]
            a[same] += 1 << k
            b[same] += 1 << k
            n[same] += 1 << k
        return n

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a and b are equal, within their sequence; a < b."""
        low, a, b, n = self.begin[a], a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            fits = np.flatnonzero(a - (1 << k) >= low)
            same = fits[self.ranks[k][a[fits] - (1 << k)] == self.ranks[k][b[fits] - (1 << k)]]
            a[same] -= 1 << k
            b[same] -= 1 << k
            n[same] += 1 << k
        return n


class WaveletMatrix:
    """Numbers in a fixed order; counts and finds those of a range by value, one bit at a time for many ranges at once."""

    def __init__(self, values: np.ndarray, most: int):
        self.bits, self.planes = max(1, int(most).bit_length()), []
        for bit in range(self.bits - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(values) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(words)[:-1], dtype=np.int64)))
            self.planes.append((words, before, len(values) - int(ones.sum())))
            values = np.concatenate((values[~ones], values[ones]))

    @staticmethod
    def ones_before(plane, at: np.ndarray) -> np.ndarray:
        words, before, _ = plane
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[at >> 6] + np.bitwise_count(words[at >> 6] & low)

    def count_below(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of the numbers at left..right-1 are less than the bound."""
        left, right, count = left.copy(), right.copy(), np.zeros(len(left), np.int64)
        for nth, plane in enumerate(self.planes):
            one = (bound >> (self.bits - 1 - nth) & 1).astype(bool)
            l1, r1 = self.ones_before(plane, left), self.ones_before(plane, right)
            zeros = (right - r1) - (left - l1)
            count += np.where(one, zeros, 0)
            left = np.where(one, plane[2] + l1, left - l1)
            right = np.where(one, plane[2] + r1, right - r1)
        return np.where(bound >> self.bits > 0, count + right - left, count)

    def nth_smallest(self, left: np.ndarray, right: np.ndarray, nth: np.ndarray) -> np.ndarray:
        left, right, nth, value = left.copy(), right.copy(), nth.copy(), np.zeros(len(left), np.int64)
        for plane in self.planes:
            l1, r1 = self.ones_before(plane, left), self.ones_before(plane, right)
            zeros = (right - r1) - (left - l1)
            one = nth >= zeros
            nth = np.where(one, nth - zeros, nth)
            left = np.where(one, plane[2] + l1, left - l1)
            right = np.where(one, plane[2] + r1, right - r1)
            value = value << 1 | one
        return value


def spread(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts c0, c1, ...: index 0 c0 times, 1 c1 times, ... and the number within each."""
    of = np.repeat(np.arange(len(count)), count)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)


def candidates(order: SuffixOrder):
    """(place, distance) pairs, as arrays, that hold every run: its period and a block within it and its repeat."""
    level = LEAST_BLOCK.bit_length() - 1
    if level >= len(order.ranks):
        return
    # blocks of a size have another occurrence only among suffixes that share their first four words with others
    several = np.bincount(order.ranks[level][:-1], minlength=order.size)[order.ranks[level][order.order]] > 1
    matrix = WaveletMatrix(order.order[several], order.size)
    compact = np.concatenate(([0], np.cumsum(several)))
    del several
    while level < len(order.ranks):
        rank, block = order.ranks[level], 1 << level
        sizes = np.bincount(rank[:-1], minlength=order.size)
        # a run of 12 words with a period of 6 holds a block of four that begins at an even place in its first six words
        at = np.arange(0, order.size, 2 if block == LEAST_BLOCK else block)
        at = at[sizes[rank[at]] > 1]
        left = compact[rank[at]]
        right = left + sizes[rank[at]]
        # occurrences that begin within block + 1 places of each other are one progression
        first, last = (1, 4 * block - 2) if block == LEAST_BLOCK else (2 * block - 1, 4 * block - 2)
        bounds = [*range(first, last + 1, block + 1), last + 1]
        below = matrix.count_below(left, right, at + first)
        for low, high in zip(bounds, bounds[1:], strict=False):
            upto = matrix.count_below(left, right, at + high)
            found = np.flatnonzero(upto > below)
            own, n, skip = at[found], (upto - below)[found], below[found]
            l, r = left[found], right[found]
            below = upto
            if not len(found):
                continue
            next_at = matrix.nth_smallest(l, r, skip)
            yield own, next_at - own
            many = np.flatnonzero(n > 1)
            own, next_at, n = own[many], next_at[many], n[many]
            apart = matrix.nth_smallest(l[many], r[many], skip[many] + 1) - next_at
            pair = n == 2
            yield own[pair], (next_at + apart - own)[pair]
            own, next_at, apart, n = own[~pair], next_at[~pair], apart[~pair], n[~pair]
            # three and more: the block has the period apart; within one stretch of it every other distance is a multiple
            one = own - order.backward(own, own + apart) != next_at - order.backward(next_at, next_at + apart)
            of, nth = spread(n[one] - 1)
            yield own[one][of], (next_at[one] - own[one])[of] + apart[one][of] * (nth + 1)
            yield own[~one], apart[~one]
        level += 1


def find_runs(words: np.ndarray, sequence: np.ndarray, starts: np.ndarray, least: int = LEAST_RUN):
    """Arrays (start, length, period) of all maximal runs of at least max(least, 2 * period) words, by start and period.

    words: numbers that stand for words; sequence: the number of each word's sequence, ascending; starts: where sequences begin.
    """
    empty = np.zeros(0, np.int64)
    if len(words) < least:
        return empty, empty, empty
    order = SuffixOrder(words, sequence, starts)
    found = []
    for at, distance in candidates(order):
        start = at - order.backward(at, at + distance)
        length = at + order.forward(at, at + distance) + distance - start
        good = (length >= np.maximum(least, 2 * distance)) & (distance > 0)
        found.append(np.unique(np.stack((start[good], length[good], distance[good])), axis=1))
    if not found:
        return empty, empty, empty
    start, length, period = np.unique(np.concatenate(found, axis=1), axis=1)
    # a multiple of a run's period gives the run again; the least stays
    least_one = np.ones(len(start), bool)
    least_one[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[least_one], length[least_one], period[least_one]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def periodic_runs(docs: DataFrame, least: int = LEAST_RUN) -> DataFrame:
    """The runs of each whole text (doc_id, text): n_words, runs (start, length, period; by start, then period), collapsed.

    A run is a stretch of at least max(least, 2 * period) words whose words a smallest period apart are equal, and that no
    neighbouring word extends. least: at least 12. collapsed: the words joined by one blank without those that a run holds
    behind its first period. Words are stretches of anything but ASCII white space.

    One row per input row; ids may be missing or repeated and are carried. NULL, empty and blank texts have no words, no
    runs and an empty collapsed text. Extra columns are ignored; no rows give no rows. Nothing is shuffled: runs lie within a
    text. Some megabytes of texts are searched at once, a longer text by itself; memory grows with its words times the
    binary logarithm of its longest repeat.
    """
    if least < LEAST_RUN:
        raise ValueError(f"runs are found from {LEAST_RUN} words on")

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            texts = batch.column("text").fill_null("")
            for at, some in slices_by_size(texts, 4_000_000):
                split = [t.split() for t in some.cast(pa.binary()).to_pylist()]  # bytes are split at ASCII white space
                sizes = np.fromiter(map(len, split), np.int64, len(split))
                starts = np.cumsum(sizes) - sizes
                flat = [w for own in split for w in own]
                words = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
                sequence = np.repeat(np.arange(len(split)), sizes)
                start, length, period = find_runs(words, sequence, starts, least)
                of = sequence[start]
                edges = np.zeros(len(flat) + 1, np.int64)
                np.add.at(edges, start + period, 1)
                np.add.at(edges, start + length, -1)
                gone = np.cumsum(edges[:-1]) > 0
                touched = set(of.tolist())
                texts_left = []
                for i, own in enumerate(split):
                    if i in touched:
                        dropped = gone[starts[i] : starts[i] + sizes[i]].tolist()
                        own = [w for w, d in zip(own, dropped, strict=True) if not d]
                    texts_left.append(b" ".join(own))
                n_runs = np.bincount(of, minlength=len(split))
                bounds = np.concatenate(([0], np.cumsum(n_runs))).astype(np.int32)
                fields = [pa.array(x) for x in (start - starts[of], length, period)]
                runs = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(fields, fields=list(kind.value_type)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(some)), pa.array(sizes), runs, pa.array(texts_left, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, RESULT_SCHEMA)


by_value(__name__)
