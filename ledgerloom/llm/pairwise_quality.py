"""Quality scores learned from preference pairs (Bradley-Terry), with a score quantile as threshold."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import in_remainder
from ledgerloom.llm.workers import by_value

#: Classes of bytes; the last three are other ASCII, continuation bytes and lead bytes of UTF-8.
BYTE_CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",", b"!", b"?;:'\"-", b"#$%&*", b"|",
)


def class_table() -> np.ndarray:
    n = len(BYTE_CLASSES)
    table = np.full(256, n, np.uint8)
    for i, members in enumerate(BYTE_CLASSES):
        table[np.frombuffer(members, np.uint8)] = i
    table[0x80:0xC0], table[0xC0:] = n + 1, n + 2
    return table


def distinct_share(values: np.ndarray) -> float:
    return len(np.unique(values)) / len(values) if len(values) else 1.0


def text_features(text: bytes, table: np.ndarray) -> np.ndarray:
    """How characters follow each other, and how much words, word triples and lines repeat; no words themselves."""
    classes = len(BYTE_CLASSES) + 3
    codes = table[np.frombuffer(text, np.uint8)]
    pairs = np.bincount(codes[:-1].astype(np.int32) * classes + codes[1:], minlength=classes * classes)
    words, lines = text.split(), text.split(b"\n")
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    triples = hashes[:-2] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[2:]
    repeats = (hashes[1:] == hashes[:-1]).mean() if len(words) > 1 else 0.0
    rest = [
        distinct_share(hashes), distinct_share(triples), repeats, np.log1p(len(words)) / 10, np.log1p(len(text)) / 10,
        len(text) / max(1, len(words)) / 20, len(set(lines)) / len(lines), np.log1p(len(lines)) / 5,
    ]
    return np.concatenate((np.sqrt(pairs / max(1, len(codes) - 1)), rest)).astype(np.float32)


def feature_rows(docs: DataFrame, carried: str) -> DataFrame:
    """The carried columns (a schema string) and the features as raw 32-bit floats."""
    names = [part.split()[0] for part in carried.split(",")]

    def run(batches):
        import pyarrow as pa

        table = class_table()
        for batch in batches:
            raw = [text_features(t.as_buffer().to_pybytes() if t.is_valid else b"", table).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(raw, pa.binary())], [*names, "features"])

    return docs.select(*names, F.col("text").cast("string").alias("text")).mapInArrow(run, f"{carried}, features binary")


def fit_pairs(features: np.ndarray, quality: np.ndarray, steps: int, pairs: int, seed: int) -> dict:
    """Weights that rank good rows over bad ones: logistic loss on feature differences of random preference pairs.

    The threshold is the quantile of the fitted rows' scores at the share of bad rows.
    """
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    rows = (features - mean) / scale
    good, bad = np.flatnonzero(quality == 1), np.flatnonzero(quality == 0)
    random = np.random.default_rng(seed)
    weights, first, second = np.zeros(rows.shape[1]), 0.0, 0.0
    for step in range(steps):
        gap = rows[random.choice(good, pairs)] - rows[random.choice(bad, pairs)]
        wrong = 1 / (1 + np.exp(np.clip(gap @ weights, -60, 60)))
        slope = 1e-3 * weights - (gap * wrong[:, None]).mean(axis=0)
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope * slope
        weights = weights - 0.05 * (1 - step / steps) * first / (np.sqrt(second) + 1e-8)
    scores = np.sort(rows @ weights)
    cut = (scores[len(bad) - 1] + scores[len(bad)]) / 2
    spread = max(float(scores.std()) / 2, 1e-6)
    return {"weights": (weights / scale).astype(np.float64), "shift": float(mean @ (weights / scale)), "cut": float(cut), "spread": spread}


def quality_scores(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_labelled: int = 6000,
    steps: int = 600, pairs: int = 512, seed: int = 3,
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Score and verdict for every document (doc_id, text), learned from labels (doc_id, quality 0 or 1).

    Rows whose crc32(doc_id as text) mod 5 is 0 are held out of learning. Of the others at most max_labelled labelled
    rows, the first by a hash of their id, are used for fitting; their features (a kilobyte each) are all that the driver sees.
    Scores come from a Bradley-Terry model on the features of whole texts and are mapped to (0, 1) by a logistic
    curve that takes the quantile threshold to `threshold`.

    Returns one row per input row: the carried columns, held_out, score, predicted (1 where score >= threshold). NULL and empty texts get
    the score of the features of an empty text. NULL ids are not held out and match no label; NULL qualities are not used;
    repeated labels count each; of several documents with a labelled id, the one with the smallest features is learned from. With labels of one kind only, every score is that label; without labels it is 0.5. No rows
    give no rows; extra columns are ignored. Nothing is shuffled but the labels.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("quality"))
    marks = marks.filter(F.col("quality").isin(0, 1) & ~in_remainder("_id", 5, 0) & F.col("_id").isNotNull())
    marks = marks.orderBy(F.xxhash64(F.lit(seed), F.col("_id")), "_id", "quality").limit(max_labelled)
    marks = marks.groupBy("_id", "quality").agg(F.count("*").cast("int").alias("times"))
    # at most max_labelled rows, here and, as each id gives one row, behind the join
    known = docs.select("doc_id", "text").join(F.broadcast(marks), F.col("doc_id") == F.col("_id"))
    known = feature_rows(known.select("doc_id", "quality", "times", "text"), "doc_id long, quality int, times int")
    known = known.groupBy("doc_id", "quality", "times").agg(F.min("features").alias("features"))
    sample = sorted((r["doc_id"], r["quality"], r["features"]) for r in known.collect() for _ in range(r["times"]))
    quality = np.array([r[1] for r in sample])
    if len(set(quality.tolist())) == 2:
        features = np.stack([np.frombuffer(r[2], np.float32) for r in sample]).astype(np.float64)
        model = fit_pairs(features, quality, steps, pairs, seed)
    else:
        model = {"same": float(quality[0]) if len(quality) else 0.5}

    def run(batches):
        import pyarrow as pa

        table, shift = class_table(), np.log(threshold / (1 - threshold))
        for batch in batches:
            if "same" in model:
                scores = np.full(batch.num_rows, model["same"])
            else:
                raw = np.array([
                    text_features(t.as_buffer().to_pybytes() if t.is_valid else b"", table).astype(np.float64) @ model["weights"]
                    for t in batch.column("text")
                ])
                over = (raw - model["shift"] - model["cut"]) / model["spread"]
                scores = 1 / (1 + np.exp(-np.clip(over + shift, -700, 700)))
            predicted = (scores >= threshold).astype(np.int32)
            columns = [*(batch.column(f"_{c}") for c in carry), batch.column("held_out"), pa.array(scores, pa.float64()), pa.array(predicted)]
            yield pa.RecordBatch.from_arrays(columns, [*carry, "held_out", "score", "predicted"])

    carried = [F.col(c).alias(f"_{c}") for c in carry]
    slim = docs.select(*carried, in_remainder("doc_id", 5, 0).alias("held_out"), F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return slim.mapInArrow(run, f"{schema}, held_out boolean, score double, predicted int")


by_value(__name__)
