"""Token ids of whole texts, with every distinct space-delimited word tokenized once per batch of documents."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from ledgerloom.llm.workers import by_value

MEMO_WORDS = 500_000
#: Marks that are one piece after letters, however many, where nothing else follows.
MARKS = ".,!?;:%&*#$|"


def lines_of(word: str) -> list[str]:
    """A word cut before its line breaks, if each of them stands between characters that are not white space."""
    lines = word.split("\n")
    if lines != word.split() and any(not x or x[0].isspace() or x[-1].isspace() for x in lines):
        return [word]
    return [lines[0], *("\n" + x for x in lines[1:])]


def laid_out(table: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The stretches of a table that have the given numbers, one after the other; sizes are those of all its stretches."""
    starts, each = np.cumsum(sizes, dtype=np.int64) - sizes, sizes[codes]
    ends = np.cumsum(each, dtype=np.int64)
    return table[np.arange(ends[-1]) + np.repeat(starts[codes] - ends + each, each)]


class WordMemo:
    """Joins the ids of a text's words; encode turns strings into raw id arrays, each string by itself.

    Byte-level pre-tokenizers attach a blank to what follows it, so a text may be cut before any single space that stands
    between two characters that are not white space: the parts' ids, joined, are the text's. A part that is empty
    or has white space at a cut (runs of blanks, blanks at line ends) voids the cuts, and the text is encoded whole.
    Words are joined from what is known of their letters, marks and line breaks, all pieces of their own.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], kind: str):
        self.encode, self.kind = encode, np.dtype(kind)
        self.words, self.bare, self.marks = {}, {}, {}  # with a blank before them, without, and marks
        self.line_break = encode(["\n"])[0]

    def raw_ids(self, bases: list[str], lettered: np.ndarray, blank: str) -> list[bytes | None]:
        """Raw ids of pieces: what starts with a line break stands alone, before all others goes the blank.

        None for those that may not be cut off, and for lettered ones that are not letters to Python, too.
        """
        known = self.words if blank else self.bare
        found = list(map(known.get, bases))
        at, strings, behind, later = [], [], [], []  # later: letters behind a line break
        for i, ids in enumerate(found):
            if ids is None:
                base = bases[i]
                if base.isalpha():
                    at.append(i)
                    strings.append(blank + base)
                elif base[:1] == "\n" and base[1:].isalpha():
                    behind.append(i)
                    later.append(base[1:])
                elif base and not lettered[i] and not base[-1].isspace() and (base[0] == "\n" or not (blank and base[0].isspace())):
                    at.append(i)
                    strings.append(base if base[0] == "\n" else blank + base)
        for i, ids in zip(at, self.encode(strings), strict=True):
            known[bases[i]] = found[i] = ids
        for i, ids in zip(behind, self.encode(later), strict=True):
            known[bases[i]] = found[i] = self.line_break + ids
        return found

    def resolve(self, words, blank: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of an Arrow array of words with or without a blank before them, how many each has, and which may not be cut off.

        Words are cut at line breaks, and letters from the marks behind them; only these pieces are kept for later calls.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        void, n_parts = np.zeros(len(words), bool), np.ones(len(words), np.int64)
        broken = np.flatnonzero(pc.match_substring(words, "\n").to_numpy(zero_copy_only=False))
        lines = []
        for i, word in zip(broken.tolist(), strings_of(words.take(pa.array(broken))), strict=True):
            own = lines_of(word)
            if len(own) > 1:
                n_parts[i] = len(own)
                lines += own
            elif blank and word[0].isspace():  # not to be taken for a line
                void[i] = True
        whole = n_parts == 1
        parts = pa.concat_arrays([words.filter(pa.array(whole)), pa.array(lines, words.type)])
        part_from = np.empty(len(words), np.int64)  # a word's first part; its others follow
        part_from[whole] = np.arange(whole.sum())
        part_from[~whole] = whole.sum() + np.cumsum(n_parts[~whole]) - n_parts[~whole]
        word_from = np.cumsum(n_parts) - n_parts
        order = np.arange(n_parts.sum()) + np.repeat(part_from - word_from, n_parts)

        letters = pc.utf8_rtrim(parts, MARKS)
        lettered = pc.utf8_is_alpha(pc.utf8_ltrim(letters, "\n"))
        coded = pc.if_else(lettered, letters, parts).dictionary_encode()
        lettered, codes = lettered.to_numpy(zero_copy_only=False), coded.indices.to_numpy()
        of_bases = np.zeros(len(coded.dictionary), bool)
        of_bases[codes[lettered]] = True
        found = self.raw_ids(strings_of(coded.dictionary), of_bases, blank)
        missing = np.fromiter((ids is None for ids in found), bool, len(found))
        if missing.any():
            found = [ids or b"" for ids in found]

        tail = (pc.binary_length(parts).to_numpy() - pc.binary_length(letters).to_numpy()) * lettered
        ended = np.flatnonzero(tail)
        marks = [w[-n:] for w, n in zip(strings_of(parts.take(pa.array(ended))), tail[ended].tolist(), strict=True)]
        places = {m: len(found) + i for i, m in enumerate(dict.fromkeys(marks))}
        fresh = [m for m in places if m not in self.marks]
        self.marks.update(zip(fresh, self.encode(fresh), strict=True))
        found += map(self.marks.get, places)
        mark_codes = np.zeros(len(parts), np.int64)
        mark_codes[ended] = [places[m] for m in marks]

        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        marked = tail[order] > 0
        piece_from = np.cumsum(1 + marked) - 1 - marked
        pieces = np.empty(len(order) + marked.sum(), np.int64)
        pieces[piece_from] = codes[order]
        pieces[piece_from[marked] + 1] = mark_codes[order[marked]]
        counts = np.add.reduceat(sizes[pieces], piece_from[word_from])
        void |= np.logical_or.reduceat(missing[codes[order]], word_from)
        return laid_out(np.frombuffer(b"".join(found), self.kind), sizes, pieces), counts, void

    def ids(self, texts):
        """(start, texts, their ids laid end to end, number of ids of each) for parts of an Arrow text column; NULL is empty.

        Words are told apart for some megabytes at once, and ids gathered for fewer at a time.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        for start, some in slices_by_size(pc.fill_null(texts, ""), 10_000_000):
            for at, part, ids, counts in self.ids_of_some(some):
                yield start + at, part, ids, counts
            pa.default_memory_pool().release_unused()  # workers live on between tasks

    def ids_of_some(self, texts):
        import pyarrow as pa
        import pyarrow.compute as pc

        if len(self.words) + len(self.bare) > MEMO_WORDS:
            self.words, self.bare, self.marks = {}, {}, {}
        split = pc.split_pattern(texts, pattern=" ")
        first = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        del split
        codes = coded.indices.to_numpy().copy()
        begins = coded.dictionary.take(pa.array(codes[first[:-1]]))
        codes[first[:-1]] = len(coded.dictionary) + np.arange(len(begins))
        resolved = self.resolve(coded.dictionary, " "), self.resolve(begins, "")
        table, sizes, void = (np.concatenate(both) for both in zip(*resolved, strict=True))
        del coded, begins, resolved
        for at, part in slices_by_size(texts):
            own = codes[first[at] : first[at + len(part)]]
            bounds = first[at : at + len(part)] - first[at]
            out = laid_out(table, sizes, own)
            counts = np.add.reduceat(sizes[own], bounds)
            whole = np.flatnonzero(np.logical_or.reduceat(void[own], bounds))
            if len(whole):
                parts = np.split(out, np.cumsum(counts)[:-1])
                for i, raw in zip(whole.tolist(), self.encode(part.take(whole).to_pylist()), strict=True):
                    parts[i] = np.frombuffer(raw, self.kind)
                    counts[i] = len(parts[i])
                out = np.concatenate(parts)
            yield at, part, out, counts


def strings_of(column) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def slices_by_size(column, most: int = 3_000_000):
    """(start, texts) of parts of an Arrow text column without NULLs, with some megabytes each."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield at, column.slice(at, to - at)
        at = to


by_value(__name__)
