"""Top-k products, tokenizer alignment and periodic runs against plain versions, on the sample and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import bit_sliced, periodic_runs, token_alignment
from ledgerloom.llm.queries import QUERIES
from test_odd_documents import as_sorted, id_texts, no_docs, odd_docs, odd_rows  # noqa: F401

SMALL = "/root/testdata/sf0.001"
JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def texts(sf_dir):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


# top-k products


def plain_top(rows, k, divisor=50, scale=256):
    """rows: (vec_id, vector). Sorted (query_id, rank, vec_id, score)."""
    usable = []
    for i, v in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            usable.append((i, [int(np.floor(float(np.float32(x)) * scale)) for x in v]))
    out = []
    for n, (i, q) in enumerate(usable):
        if i is None or i % divisor:
            continue
        found = [
            (-sum(a * b for a, b in zip(q, v, strict=True)), j is None, j or 0)
            for m, (j, v) in enumerate(usable)
            if m != n and len(v) == len(q)
        ]
        out += [(i, r, None if none else j, -s) for r, (s, none, j) in enumerate(sorted(found)[:k], 1)]
    return out


def test_top_products_sample(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SMALL}/embeddings.parquet'").fetchall()
    out = QUERIES["op11_top_products"](spark, SMALL).collect()
    assert len(out) == 50 and as_sorted(out) == as_sorted(plain_top(rows, 5))


VECTORS = "vec_id long, embedding array<float>, score string, block int"


@pytest.mark.parametrize("block_rows", [7, 64, 100, 5000])
def test_top_products_odd_vectors(spark, block_rows):
    draw = random.Random(block_rows)
    near = [draw.gauss(0, 0.2) for _ in range(6)]
    rows = [(i, [draw.gauss(0, 0.3) for _ in range(6)]) for i in range(-60, 300)]
    rows += [(1000 + i, near) for i in range(80)] + [(1000, near), (None, near), (None, None)]  # ties, repeats, no id
    rows += [(2000 + 50 * i, v) for i, v in enumerate([None, [], [], [0.0] * 6, [None] * 6, [float("nan")] * 6, [float("inf")] * 6])]
    rows += [(3000 + 25 * i, [100.0 * i, -3.0]) for i in range(4)] + [(3500, [1.0] * 3)]
    table = spark.createDataFrame([(i, v, "s", 3) for i, v in rows], VECTORS).repartition(3)
    out = bit_sliced.top_products(table, F.col("vec_id") % 50 == 0, k=5, block_rows=block_rows)
    assert as_sorted(out.collect()) == as_sorted(plain_top(rows, 5))
    everyone = bit_sliced.top_products(table, F.col("vec_id") % 50 == 0, k=1000, block_rows=block_rows)
    assert as_sorted(everyone.collect()) == as_sorted(plain_top(rows, 1000))


def test_top_products_without_rows(spark):
    table = spark.createDataFrame([], VECTORS)
    assert bit_sliced.top_products(table, F.col("vec_id") % 50 == 0, k=5).count() == 0
    some = spark.createDataFrame([(1, [1.0], "s", 0)], VECTORS)
    assert bit_sliced.top_products(some, F.col("vec_id") % 50 == 0, k=5).count() == 0


def test_sums_of_slices():
    rng = np.random.default_rng(3)
    rows = rng.integers(-300, 300, (200, 9))
    lows, widths, slices = bit_sliced.to_slices(rows)
    for q in rng.integers(-300, 300, (20, 9)):
        digits = np.zeros(9, np.int64)
        for power, at, negative in bit_sliced.signed_digits(q):
            digits[at] += np.where(negative, -1, 1) << power
        assert (digits == q).all()


# tokenizer alignment


def plain_alignment(rows):
    """rows: (doc_id, text). Whole texts, token by token; sorted rows of the query."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(JSON)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spelled = {chr(v): v for v in visible} | {chr(256 + n): v for n, v in enumerate(x for x in range(256) if x not in visible)}

    def spans(pieces):
        at, out = 0, []
        for content in pieces:
            out.append((at, at + len(content)))
            at += len(content)
        return out

    found = []
    for doc, text in rows:
        content = (" " + (text or "")).encode()
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(spelled[c] for c in a.id_to_token(i)) for i in ids_a]
        names = [b.id_to_piece(i) for i in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in names]
        if not text or b"".join(bytes_a) != content or b"".join(bytes_b) != content:
            found.append((doc, [], [], 0, [], ""))
            continue
        spans_a, spans_b = spans(bytes_a), spans(bytes_b)
        ends = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
        groups, at = [], [0, 0]
        for high in ends:
            sides = []
            for k, (ids, own) in enumerate(((ids_a, spans_a), (ids_b, spans_b))):
                first = at[k]
                while at[k] < len(own) and own[at[k]][1] <= high:
                    at[k] += 1
                sides.append(",".join(map(str, ids[first : at[k]])))
            groups.append("|".join(sides))
        links, j0 = [], 0
        for i, (s, e) in zip(ids_a, spans_a, strict=True):
            while spans_b[j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(spans_b) and spans_b[j][0] < e:
                links.append((i, ids_b[j]))
                j += 1
        found.append((doc, ids_a, ids_b, len(ends), links, sha(";".join(groups))))
    counts = Counter(link for f in found for link in f[4])
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(n, most.get(j, 0))
    return as_sorted(
        (doc, len(x), len(y), g, len(links), sum(counts[k] == most[k[1]] for k in links), sum(counts[k] for k in links), s)
        for doc, x, y, g, links, s in found
    )


def test_alignment_sample(spark):
    out = QUERIES["op12_token_alignment"](spark, SMALL).collect()
    assert as_sorted(out) == plain_alignment(texts(SMALL))


@pytest.mark.parametrize("slice_bytes", [60, 100_000])
def test_alignment_odd_documents(spark, odd_docs, odd_rows, monkeypatch, slice_bytes):  # noqa: F811
    monkeypatch.setattr(token_alignment, "SLICE_BYTES", slice_bytes)
    marked = [(900 + i, t) for i, t in enumerate(["a▁b c", "tab\tbed", "x\x00y", "<s> <0x41> é\n\nü", " blank", "blank ", "naïve—café’s\nNext line\n", "\nfirst", "end\n"])]
    extra = spark.createDataFrame(marked, "doc_id long, text string")
    docs = odd_docs.unionByName(extra, allowMissingColumns=True)
    out = token_alignment.align_tokenizers(docs, JSON, MODEL, digests=True)
    assert as_sorted(out.collect()) == plain_alignment(id_texts(odd_rows) + marked)


def test_pieces_are_aligned_together():
    aligner = token_alignment.Aligner(Path(JSON).read_text(encoding="utf-8"), Path(MODEL).read_bytes())
    texts_ = ["unbelievable", "naïve—café’s", "x▁y", "zzqxjkv123,,", "x\x00y", "a"]
    contents, ids = [f" {t}".encode() for t in texts_], aligner.ids(texts_)
    together = aligner.align(contents, *ids)
    assert together == [aligner.align([c], [a], [b])[0] for c, a, b in zip(contents, *ids, strict=True)]
    assert together[2] is None and together[0] is not None
    assert aligner.align(contents[2:3], ids[0][2:3], ids[1][2:3]) == [None]


def test_alignment_of_no_documents(no_docs):  # noqa: F811
    assert token_alignment.align_tokenizers(no_docs, JSON, MODEL).count() == 0


def test_groups_as_text(spark):
    docs = spark.createDataFrame([(1, "unbelievable things"), (2, None)], "doc_id long, text string")
    out = {r["doc_id"]: r["groups"] for r in token_alignment.align_tokenizers(docs, JSON, MODEL).collect()}
    assert out[2] == "" and re.fullmatch(r"(\d+(,\d+)*\|\d+(,\d+)*;?)+", out[1])


# periodic runs


def plain_runs(words, least=12):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc).encode()), len(words)
    g = h // 10
    if doc is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def plain_run_rows(rows):
    out = []
    for doc, text in rows:
        words = planted(doc, text)
        runs = plain_runs(words)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        out.append((doc, len(runs), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs))))
    return as_sorted(out)


def test_periodic_runs_sample(spark):
    rows = [(d, t) for d, t in texts(SMALL) if len(t.split()) < 700]
    expected = plain_run_rows(rows)
    told = {r[0] for r in rows}
    out = [r for r in QUERIES["op13_periodic_runs"](spark, SMALL).collect() if r["doc_id"] in told]
    assert as_sorted(out) == expected and sum(r[1] for r in expected) > 0


def test_periodic_runs_odd_documents(spark, odd_docs, odd_rows, tmp_path):  # noqa: F811
    rows = [r for r in odd_rows if len(r[1] or "") < 100_000]
    path = str(tmp_path / "documents.parquet")
    odd_docs.filter("text IS NULL OR length(text) < 100000").write.parquet(path)
    assert as_sorted(QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()) == plain_run_rows(id_texts(rows))


def test_periodic_runs_of_no_documents(no_docs):  # noqa: F811
    assert periodic_runs.periodic_runs(no_docs).count() == 0


def test_very_long_periodic_text(spark):
    docs = spark.createDataFrame([(1, "x " + "a b c " * 100_000 + "y")], "doc_id long, text string")
    row = periodic_runs.periodic_runs(docs).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 300_000, 3)] and row["collapsed"] == "x a b c y"


def sequences(draw):
    """Word sequences over small alphabets: random, periodic, Fibonacci words, squares that touch, several stretches."""
    kind, k, n = draw.randrange(5), draw.choice([1, 2, 2, 3, 5, 50]), draw.randrange(140)
    if kind == 0:
        return [draw.randrange(k) for _ in range(n)]
    if kind == 1:
        unit = [draw.randrange(k) for _ in range(draw.randrange(1, 40))]
        return [draw.randrange(9) for _ in range(draw.randrange(30))] + (unit * 140)[:n] + [draw.randrange(9) for _ in range(draw.randrange(30))]
    if kind == 2:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind == 3:
        unit = [0, 1] * draw.randrange(1, 12) + [0]
        return [1] * draw.randrange(2) + unit + unit + [1] * draw.randrange(2) + unit
    parts = [([draw.randrange(k) for _ in range(draw.randrange(1, 9))] * 40)[: draw.randrange(40)] for _ in range(4)]
    return [w for part in parts for w in part]


@pytest.mark.parametrize("seed", range(20))
def test_find_runs(seed):
    draw = random.Random(seed)
    own = [sequences(draw) for _ in range(60)]
    sizes = np.array([len(s) for s in own])
    starts = np.cumsum(sizes) - sizes
    sequence = np.repeat(np.arange(len(own)), sizes)
    found = [[] for _ in own]
    arrays = periodic_runs.find_runs(np.array([w for s in own for w in s]), sequence, starts)
    for s, n, q in zip(*(x.tolist() for x in arrays), strict=True):
        found[sequence[s]].append((s - int(starts[sequence[s]]), n, q))
    assert found == [plain_runs(s) for s in own]


def test_wavelet_matrix():
    rng = np.random.default_rng(5)
    values = rng.permutation(500)
    matrix = periodic_runs.WaveletMatrix(values, 500)
    left = rng.integers(0, 400, 300)
    right = left + rng.integers(1, 100, 300)
    bound = rng.integers(0, 512, 300)
    assert matrix.count_below(left, right, bound).tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(left, right, bound, strict=True)]
    nth = rng.integers(0, right - left)
    assert matrix.nth_smallest(left, right, nth).tolist() == [int(np.sort(values[a:b])[x]) for a, b, x in zip(left, right, nth, strict=True)]
