"""The pipeline against a plain version, stage by stage on each stage's own input."""

from collections import Counter

import corpus_pipeline
import duckdb
from corpus_pipeline import COLUMNS, STAGES
from ledgerloom.session import staged
from plain import exact_groups, simhash_components

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs, seen = corpus_pipeline.documents(spark, SMALL), []
    for name, stage in STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()] if seen != ["mixing"] else []
        docs = staged(stage(spark, docs, SMALL), name)
        after = docs.collect()
        pairs = [(r[0], r[1]) for r in before]
        if name != "byte_bpe":
            assert docs.columns == list(COLUMNS)
        ids = Counter(r["doc_id"] for r in after)
        if name == "quality":
            marks = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SMALL}/labels.parquet'").fetchall())
            known = [d for d, *_ in before if d in marks]
            assert sum((d in ids) == (marks[d] == 1) for d in known) > 0.95 * len(known)
        if name == "exact_dedup":
            assert ids == Counter(d for d, _, _, kept, _ in exact_groups(pairs) if kept)
        if name == "near_dedup":
            assert ids == Counter(d for d, _, component in simhash_components(pairs) if d == component)
        if name == "mixing":
            size = {d: len((t or "").encode().split()) for d, t in pairs}
            assert set(ids) <= set(size) and max(ids.values()) <= 2
            words = sum(size[d] * n for d, n in ids.items())
            assert abs(words - 1.5 * sum(size.values())) < 0.1 * sum(size.values())
        if name == "byte_bpe":
            assert ids == Counter(d for d, *_ in before)
        seen.append(name)


def test_run_is_the_stages(spark):
    docs = corpus_pipeline.documents(spark, SMALL)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, SMALL), name)
    assert Counter(corpus_pipeline.run(spark, SMALL).collect()) == Counter(docs.collect())


def stage_rows(spark, name, rows):
    docs = spark.createDataFrame([(d, t, "a", s, len(t or "")) for d, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = dict(STAGES)[name](spark, docs, SMALL)
    assert out.columns == list(COLUMNS)
    return Counter((r["doc_id"], r["text"]) for r in out.collect())


def test_one_row_of_each_text_stays(spark):
    texts = {n: " ".join(f"{n}{i}" for i in range(60)) for n in "ABCDEF"}
    rows = [(5, "A"), (5, "B"), (9, "B"), (None, "C"), (None, "D"), (7, "D"), (None, "E"), (None, "E"), (3, "F"), (3, "F")]
    rows = [(d, texts[t], "s") for d, t in rows] + [(11, None, "s"), (11, "", "s")]
    wanted = [(5, "A"), (9, "B"), (None, "C"), (7, "D"), (None, "E"), (3, "F")]
    assert stage_rows(spark, "exact_dedup", rows) == Counter([(d, texts[t]) for d, t in wanted] + [(11, "")])
    assert sum(stage_rows(spark, "exact_dedup", [(None, None, "s")] * 3).values()) == 1


def test_one_row_of_each_near_group_stays(spark):
    from plain import simhash

    texts = {n: " ".join(f"{n}{i}" for i in range(60)) for n in "ABCDEF"}
    assert all((simhash(a) ^ simhash(b)).bit_count() > 4 for a in texts.values() for b in texts.values() if a != b)
    variant = {n: t.upper() for n, t in texts.items()}  # another text, the same fingerprint
    rows = [(5, texts["A"]), (5, texts["B"]), (2, variant["B"]), (None, texts["C"]), (None, variant["C"]), (None, texts["D"]), (8, variant["D"])]
    rows += [(3, texts["E"]), (3, texts["E"]), (4, texts["F"]), (4, variant["F"])]
    found = stage_rows(spark, "near_dedup", [(d, t, "s") for d, t in rows])
    groups = Counter((d, t.lower()) for d, t in found.elements())
    assert groups == Counter((d, texts[t].lower()) for d, t in [(5, "A"), (2, "B"), (None, "C"), (8, "D"), (3, "E"), (4, "F")])


def test_mix_counts_rows_not_ids(spark):
    rows = [(None if i % 3 else 1, f"{'x y z ' * (1 + i % 5)}{i}", "abc"[i % 3]) for i in range(120)]
    found = stage_rows(spark, "mixing", rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = corpus_pipeline.mix_sources(docs, weights=(5, 2, 1), share=1.5, most=2.0, seed=11).collect()
    target = {r["source"]: r["target"] for r in mixed}
    for source in "abc":
        words = sum(len(t.split()) * found[d, t] for d, t, s in rows if s == source)
        assert abs(words - target[source]) <= 16  # the longest text: only the one where the quota ends is rounded
