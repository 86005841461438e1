"""Registered queries of the training-data operators on the smallest sample."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest

from ledgerloom.llm.queries import ORACLES, QUERIES
from plain import simhash_components, vector_links
from verification.compare import connect, difference

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def texts(sf_dir):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    con = connect(SMALL)
    assert difference(QUERIES[name](spark, SMALL).toPandas(), con.execute(ORACLES[name]).df()) is None


def test_token_files(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = {r["doc_id"]: r for r in QUERIES["op2_token_files"](spark, SMALL).collect()}
    start = 0
    for doc, text in texts(SMALL):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert tuple(out[doc]) == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_byte_bpe(spark):
    import base64

    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = {r["doc_id"]: r for r in QUERIES["op9_byte_bpe"](spark, SMALL).collect()}
    for doc, text in texts(SMALL):
        ids = coder.encode_ordinary(text)
        joined = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert tuple(out[doc]) == (doc, len(ids), joined, hashlib.sha256(text.encode()).hexdigest())


def test_simhash(spark):
    out = sorted(tuple(r) for r in QUERIES["op7_simhash"](spark, SMALL).collect())
    assert out == sorted(simhash_components(texts(SMALL)))


def test_near_vectors(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{SMALL}/embeddings.parquet'").fetchall()
    out = sorted(tuple(r) for r in QUERIES["op5_near_vectors"](spark, SMALL).collect())
    assert out == sorted(vector_links(rows, 0.93))


def test_quality_held_out(spark):
    out = QUERIES["op6_quality"](spark, MEDIUM).toPandas()
    marked = duckdb.sql(f"SELECT doc_id, quality FROM '{MEDIUM}/labels.parquet'").df().merge(out, on="doc_id")
    held = marked[marked.held_out]
    assert len(held) > 50 and (held.quality == held.predicted).mean() > 0.95
    assert len(out) == 1000 and out.score.between(0, 1).all()


def test_language_held_out(spark):
    out = QUERIES["op10_language"](spark, MEDIUM).toPandas()
    told = duckdb.sql(f"SELECT doc_id, lang FROM '{MEDIUM}/documents.parquet'").df().merge(out, on="doc_id")
    held = told[told.held_out]
    assert len(held) > 200 and (held.lang == held.lang_pred).mean() > 0.98


def test_reruns_agree(spark):
    for name in ("op6_quality", "op10_language"):
        first = QUERIES[name](spark, SMALL).toPandas()
        assert difference(first, QUERIES[name](spark, SMALL).toPandas()) is None
