"""Language identification by n-gram presence kernels with Nystroem landmarks and kernel ridge regression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import in_remainder
from ledgerloom.llm.workers import by_value

HASH_BITS, MOST_NGRAMS = 20, 65_536


def letter_table() -> np.ndarray:
    """Maps a code point below 0x10000 to itself if it is a letter, else to a blank."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(0x10000)], np.uint32)


def ngram_codes(text: str, letters: np.ndarray, longest: int) -> np.ndarray | None:
    """Hashes of all distinct n-grams of 1 to `longest` characters; None for a text without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    beyond = points >= 0x10000
    points = np.where(beyond, points, letters[points & 0xFFFF])
    for point in np.unique(points[beyond]) if beyond.any() else ():
        if not chr(point).isalpha():
            points[points == point] = 32
    if not (points != 32).any():
        return None
    # one blank between words
    points = points[np.concatenate(([True], (points[1:] != 32) | (points[:-1] != 32)))]
    flags = np.zeros(1 << HASH_BITS, bool)
    rolled = np.zeros(len(points), np.uint32)
    for n in range(min(longest, len(points))):
        rolled = (rolled[: len(points) - n] * np.uint32(0x01000193)) ^ (points[n:] + np.uint32(n + 1)) * np.uint32(0x9E3779B1)
        flags[(rolled * np.uint32(0x85EBCA6B)) >> np.uint32(32 - HASH_BITS)] = True
    return np.flatnonzero(flags).astype(np.int32)


def packed(codes: np.ndarray) -> bytes:
    """A set of hashes as a list or, where that is shorter, as a bit map of 128 kB."""
    if codes.nbytes < (1 << HASH_BITS) // 8:
        return codes.tobytes()
    flags = np.zeros(1 << HASH_BITS, bool)
    flags[codes] = True
    return np.packbits(flags).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    if len(raw) < (1 << HASH_BITS) // 8:
        return np.frombuffer(raw, np.int32)
    return np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8))).astype(np.int32)


def in_turn(ranked: list[np.ndarray], most: int) -> np.ndarray:
    """Distinct entries of several rankings, the first of each before the second of any, at most `most`."""
    entries, places = np.concatenate(ranked), np.concatenate([np.arange(len(r)) for r in ranked])
    firsts, at = np.unique(entries[np.argsort(places, kind="stable")], return_index=True)
    return firsts[np.argsort(at, kind="stable")[:most]]


class PresenceKernel:
    """k(x, y) = |x and y| / sqrt(|x| |y|) on the n-grams that several landmarks hold, `most` at most.

    An n-gram counts if min_landmarks landmarks hold it, or as many of one language (all of them, where it has fewer). Those
    most widely held stay; where that would be more than `most`, each language's own most widely held are taken in turn.
    """

    def __init__(self, column: np.ndarray):
        self.column, self.width = column, int(column.max(initial=-1)) + 1

    @classmethod
    def fit(cls, landmarks: list[np.ndarray], langs: list[str], min_landmarks: int, most: int) -> PresenceKernel:
        held = np.bincount(np.concatenate(landmarks), minlength=1 << HASH_BITS)
        usable, ranked = held >= min(min_landmarks, len(landmarks)), []
        groups = [[s for s, of in zip(landmarks, langs, strict=True) if of == name] for name in sorted(set(langs))]
        for sets in groups:
            codes, times = np.unique(np.concatenate(sets), return_counts=True)
            usable[codes[times >= min(min_landmarks, len(sets))]] = True
        kept = np.flatnonzero(usable)
        if len(kept) > most:
            for sets in groups:
                codes, times = np.unique(np.concatenate(sets), return_counts=True)
                times, codes = times[usable[codes]], codes[usable[codes]]
                ranked.append(codes[np.lexsort((codes, -held[codes], -times))[:most]])
            kept = np.sort(in_turn(ranked, most))
        column = np.full(1 << HASH_BITS, -1, np.int32)
        column[kept] = np.arange(len(kept))
        return cls(column)

    def rows(self, sets: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(sets), self.width), np.float32)
        for i, codes in enumerate(sets):
            at = self.column[codes]
            at = at[at >= 0]
            if len(at):
                out[i, at] = 1 / np.sqrt(len(at))
        return out

    def between(self, sets: list[np.ndarray], landmarks: list[np.ndarray], each: int = 128) -> np.ndarray:
        out = np.empty((len(sets), len(landmarks)), np.float32)
        for b in range(0, len(landmarks), each):
            right = self.rows(landmarks[b : b + each]).T.copy()
            for a in range(0, len(sets), each):
                out[a : a + each, b : b + each] = self.rows(sets[a : a + each]) @ right
        return out

    def ngram_weights(self, landmarks: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
        """What each n-gram adds to each language's score: the landmarks' rows, transposed, times the landmarks' weights."""
        out = np.zeros((self.width, weights.shape[1]), np.float32)
        for a in range(0, len(landmarks), 128):
            out += self.rows(landmarks[a : a + 128]).T @ weights[a : a + 128]
        return out


def fit_kernel(sets: list[np.ndarray], langs: list[str], landmarks: int, min_landmarks: int, ridge: float, most_ngrams: int = MOST_NGRAMS) -> dict:
    """One ridge regression per language on Nystroem coordinates; landmarks are taken from the languages in turn.

    There are at least min_landmarks for each language, if it has as many texts.
    """
    names = sorted(set(langs))
    of = {name: [i for i, x in enumerate(langs) if x == name] for name in names}
    picks = [of[n][k] for k in range(max(map(len, of.values()))) for n in names if k < len(of[n])]
    picks = picks[: max(landmarks, sum(min(min_landmarks, len(x)) for x in of.values()))]
    chosen = [sets[i] for i in picks]
    kernel = PresenceKernel.fit(chosen, [langs[i] for i in picks], min_landmarks, most_ngrams)
    values, vectors = np.linalg.eigh(kernel.between(chosen, chosen).astype(np.float64))
    kept = values > max(1e-6, values.max() * 1e-6)
    project = vectors[:, kept] / np.sqrt(values[kept])
    rows = kernel.between(sets, chosen) @ project
    target = (np.array(langs)[:, None] == np.array(names)[None]).astype(np.float64)
    solved = np.linalg.solve(rows.T @ rows + ridge * np.eye(rows.shape[1]), rows.T @ target)
    return {"column": kernel.column, "names": names, "weights": kernel.ngram_weights(chosen, (project @ solved).astype(np.float32))}


def predict_languages(
    docs: DataFrame, longest: int = 4, sample: int = 1600, landmarks: int = 128, min_landmarks: int = 3,
    ridge: float = 0.1, seed: int = 9, most_ngrams: int = MOST_NGRAMS,
) -> DataFrame:
    """Language of every document (doc_id, text, lang), learned from those whose crc32(doc_id as text) mod 4 is not 2.

    A text is the set of its 1- to `longest`-character n-grams (lower case, all but letters as blanks, whole text), hashed to
    2^20 codes; long texts are sets like any others. About `sample` texts with a language, an equal number of each where
    there are enough, and min_landmarks of each at least, are picked by a hash of their id and text for fitting, equal rows once; only their sets go to
    the driver. Nystroem landmarks, `landmarks` in all or min_landmarks of each language if that is more, turn the kernel into
    coordinates for one-versus-rest ridge regression. Kernel times weights is summed over the landmarks once, so a document's
    scores are sums of rows of an n-gram by language table.

    Returns one row per input row: doc_id, held_out, lang_pred, score (the winner's share of the positive scores). `und` with score
    0 where the text is NULL or has no letter, and everywhere if nothing can be learned; the most frequent language of the
    learning rows with score 0 where a text has no n-gram of the kernel. Every language
    with a learning text that has a letter is learned, with one or two texts too; the table sent to tasks has at most
    most_ngrams x languages numbers of 4 bytes. NULL ids are not held out. No rows give no rows; repeated rows get
    equal answers; extra columns are ignored. Nothing is shuffled but counts.
    """
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), in_remainder("doc_id", 4, 2).alias("held_out"),
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
    )
    learn = slim.filter(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    learn = learn.withColumn("ticket", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 40)))
    # equal rows have one ticket; the estimate errs by less than a fifth
    different = (0.8 * F.approx_count_distinct("ticket", 0.04)).cast("long").alias("different")
    counts = learn.groupBy("lang").agg(F.count("*").alias("count"), different).collect()
    each = max(min_landmarks, sample // max(1, len(counts)))
    # so many that a language with `each` texts falls short by chance once in some thousand times at most
    wanted = max(1.2 * each, each + 4 * each**0.5 + 4)
    bounds = [(r["lang"], int(min(1.0, wanted / max(1, r["different"])) * (1 << 40))) for r in counts]
    limits = docs.sparkSession.createDataFrame(bounds, "_lang string, below long")

    def sets(batches):
        import pyarrow as pa

        letters = letter_table()
        for batch in batches:
            codes = [ngram_codes(t.as_py(), letters, longest) for t in batch.column("text")]
            raw = pa.array([None if c is None else packed(c) for c in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("ticket"), raw], ["lang", "ticket", "codes"])

    chosen = learn.join(F.broadcast(limits), (F.col("lang") == F.col("_lang")) & (F.col("ticket") < F.col("below")))
    picked = chosen.select("text", "lang", "ticket").dropDuplicates(["lang", "ticket"]).mapInArrow(sets, "lang string, ticket long, codes binary")
    rows, taken = [], dict.fromkeys((r["lang"] for r in counts), 0)
    for row in sorted((r for r in picked.collect() if r["codes"] is not None), key=lambda r: (r["ticket"], r["codes"])):
        if taken[row["lang"]] < each:
            taken[row["lang"]] += 1
            rows.append(row)
    model = None
    if rows:
        model = fit_kernel([unpacked(r["codes"]) for r in rows], [r["lang"] for r in rows], landmarks, min_landmarks, ridge, most_ngrams)
        most_held = {r["lang"]: r["count"] for r in counts}
        model["usual"] = max(model["names"], key=lambda n: (most_held[n], n))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most most_ngrams x languages numbers

    def run(batches):
        import pyarrow as pa

        letters, fitted = letter_table(), shared.value
        kernel = PresenceKernel(fitted["column"]) if fitted else None
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                found = [ngram_codes(t.as_py(), letters, longest) if t.is_valid and fitted else None for t in part.column("text")]
                known = [i for i, c in enumerate(found) if c is not None]
                names, scores = ["und"] * part.num_rows, np.zeros(part.num_rows)
                if known:
                    rows = kernel.rows([found[i] for i in known])
                    values = np.maximum(rows @ fitted["weights"], 1e-9)
                    best, any_known = values.argmax(axis=1), rows.any(axis=1)
                    for i, b, share, any_held in zip(known, best, values.max(axis=1) / values.sum(axis=1), any_known, strict=True):
                        names[i], scores[i] = (fitted["names"][b], share) if any_held else (fitted["usual"], 0.0)
                columns = [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(np.minimum(scores, 1.0))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    return slim.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


by_value(__name__)
