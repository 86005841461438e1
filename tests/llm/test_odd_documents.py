"""Every document operator on rows with NULLs, empty and very long texts, ties, repeats and clashing names."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import cap_filters, chunk_dedup, common, line_dedup, merge_replay, pairwise_quality, sharding, simhash_grid, source_schedule, string_kernel, token_files
from ledgerloom.session import scratch_path
from plain import bucket, exact_groups, line_results, simhash_components

SCHEMA = "doc_id long, text string, lang string, source string, size int, digest string, kept boolean, score string, label int"


def rows_with_everything():
    """NULLs in every column, empty, blank and very long texts, ties, repeated rows and unusual characters."""
    long_text = " ".join(f"Word{i % 97} of line {i}.\n" if i % 9 == 0 else f"word{i % 89}" for i in range(60_000))
    common = "\n".join(["  Shared Line  ", "only here", "ÉCOLE shared", "a line of its own"])
    texts = [
        None, None, "", "", " \t\n", "\n\n\n", "one", "one", "One", "two words", "a b c d", "a b c d e",
        "a" * 5000, long_text, long_text + "end", "x  y   z \n w", "\ttab\t\x0b\x0cfeed\r\n", "日本語 テキスト。\nÉCOLE shared",
        "don't we'll I'M 12 345", "\U0001f600 emoji \U0001f601", "\x1c odd \x85 blanks　here", "<|endoftext|> is text",
    ]
    texts += [common + f"\n{i}" for i in range(12)] + [common] * 5
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, 1, "d", True, "s", 0) for i, t in enumerate(texts)]
    rows += [rows[-1], rows[7], (None, "one", None, None, None, None, None, None, None), (None, "no id", None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def odd_rows():
    return rows_with_everything()


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents")
    spark.createDataFrame(odd_rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)



def as_sorted(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def id_texts(rows):
    return [(r[0], r[1]) for r in rows]


@pytest.mark.parametrize("id_bits", [64, 3])
def test_chunk_dedup(odd_docs, odd_rows, id_bits):
    out = chunk_dedup.exact_dedup(odd_docs, id_bits).collect()
    assert as_sorted(out) == as_sorted(exact_groups(id_texts(odd_rows)))


def test_chunks_give_the_text_back(odd_docs):
    text = F.coalesce("text", F.lit(""))
    assert odd_docs.filter(F.array_join(chunk_dedup.chunk_list(text), "") != text).count() == 0


def test_short_identifiers_do_clash(odd_docs):
    assert chunk_dedup.chunk_variants(odd_docs, 3).count() > 0
    assert chunk_dedup.chunk_variants(odd_docs, 64).count() == 0


@pytest.mark.parametrize("min_docs", [2, 10])
def test_line_dedup(odd_docs, odd_rows, min_docs):
    bitmaps = line_dedup.recurring_line_bitmaps(odd_docs, min_docs)
    out = line_dedup.apply_line_bitmaps(odd_docs, bitmaps)
    out = out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256)).collect()
    assert as_sorted(out) == as_sorted(line_results(id_texts(odd_rows), min_docs))


def test_line_bitmaps_of_many_lines(spark):
    text = "\n".join("again" if i % 3 == 0 else f"line {i}" for i in range(1000))
    docs = spark.createDataFrame([(1, text), (2, "again"), (3, None)], "doc_id long, text string")
    bitmaps = line_dedup.recurring_line_bitmaps(docs, 2)
    assert {r["doc_id"]: len(r["words"]) for r in bitmaps.collect()} == {1: 16, 2: 1}
    out = {r["doc_id"]: r for r in line_dedup.apply_line_bitmaps(docs, bitmaps).collect()}
    assert out[1]["kept_text"] == "\n".join(f"line {i}" for i in range(1000) if i % 3)
    assert (out[2]["n_dropped"], out[2]["kept_text"], out[3]["n_lines"], out[3]["n_dropped"]) == (1, "", 1, 0)


def test_sharding(odd_docs, odd_rows):
    # two texts are far larger than a shard here; everything is dealt, without gaps
    out = sharding.interleaved_shards(odd_docs, shards=7).collect()
    raw = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in odd_rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == raw
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(7)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_keep_groups_bytes_and_mixture(spark):
    random = np.random.default_rng(8)
    rows = [(i, "w" * int(random.integers(100, 300)) + str(i), f"s{i % 4 % 3}") for i in range(6000)]
    rows += [(10_000 + i, f"copied {i % 40} " * 20, f"s{i % 3}") for i in range(400)]
    rows += [(20_000 + i, "x" * 9000 + str(i), None) for i in range(9)]
    rows += [(30_000 + i, "everywhere " * 40, "s0") for i in range(1500)]  # more than a shard
    rows += [(None, "no id and one text", "s1")] * 2500 + [(None, f"no id, text {i}", "s1") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = sharding.interleaved_shards(docs, shards=8).collect()
    assert len(out) == len(rows) and {r["law"] for r in out} == {"bytes"}
    sizes, slots, groups, mix = Counter(), defaultdict(list), defaultdict(set), defaultdict(Counter)
    for r in out:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        groups[r["text_crc32"], r["size"]].add(r["shard"])
        if r["doc_id"] is not None and r["doc_id"] < 6000:
            mix[r["source"]][r["shard"]] += 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8 and all(abs(n - mean) < mean / 32 for n in sizes.values()), sizes
    large = zlib.crc32(("everywhere " * 40).encode())
    assert all(len(shards) == (8 if crc == large else 1) for (crc, _), shards in groups.items())
    everywhere = Counter(r["shard"] for r in out if r["text_crc32"] == large)
    # the shard of the other large group has less room for it, the others have the same
    (fuller,) = groups[zlib.crc32(b"no id and one text"), 34]
    assert max(everywhere.values()) < 1.2 * min(n for shard, n in everywhere.items() if shard != fuller)
    # the source shares of a shard's own part are those of all
    parts = Counter()
    for counts in mix.values():
        parts.update(counts)
    for counts in mix.values():
        share = sum(counts.values()) / sum(parts.values())
        assert all(abs(counts[s] / parts[s] - share) < 0.06 for s in range(8)), mix


def test_missing_ids_are_spread_over_the_ranking(spark):
    rows = [(None if i % 3 == 0 else i, f"text {i}") for i in range(30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    buckets = docs.select(common.digest_bucket(common.seeded_digest("doc_id", 11, "text"), 64).alias("b")).groupBy("b").count()
    sizes = sorted(r["count"] for r in buckets.collect())
    assert len(sizes) == 64 and sizes[-1] <= 2 * sizes[32]


def test_simhash(odd_docs, odd_rows):
    out = simhash_grid.near_duplicates(odd_docs).collect()
    assert as_sorted(out) == as_sorted(simhash_components(id_texts(odd_rows)))


def test_mixing(odd_docs, odd_rows):
    out = source_schedule.mix_sources(odd_docs).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in odd_rows)
    taken, target, size = Counter(), {}, Counter()
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
    assert all(r["source_size"] == size[r["source"]] for r in out)
    assert all(taken[s] == int(target[s]) <= 2 * size[s] for s in target)
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6 * sum(size.values())
    again = source_schedule.mix_sources(odd_docs).collect()
    assert as_sorted(again) == as_sorted(out)


def test_schedule_spreads_sources(spark):
    targets = spark.createDataFrame([(0, 1000, 1500.0), (1, 1000, 750.0), (2, 0, 0.0)], "place int, source_size long, target double")
    targets = targets.withColumn("source", F.col("place").cast("string"))
    slots = source_schedule.mix_schedule(targets, 10).orderBy("turn").collect()
    assert sum(r["words"] for r in slots if r["place"] == 0) == 1500 and sum(r["words"] for r in slots if r["place"] == 1) == 750
    first = [r["place"] for r in slots]
    for n in (30, 90, 180):  # any start of the schedule has the mixture
        assert abs(first[:n].count(0) / n - 2 / 3) < 0.1
    ranks = [r["slot_rank"] for r in slots if r["place"] == 0]
    assert ranks == list(range(150))


def test_token_files(spark, odd_docs, odd_rows):
    from tokenizers import Tokenizer

    path = scratch_path(spark, "files")
    file = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_token_files(odd_docs, path, file, 50_257, 0)
    out = token_files.document_checksums(spark, path).collect()
    tokenizer = Tokenizer.from_file(file)
    wanted = Counter()
    for row in odd_rows:
        ids = np.array([*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 0], "<u4")
        wanted[row[0], len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out) == wanted
    out = sorted(out, key=lambda r: r["start"])
    starts = np.cumsum([0, *(r["n_tokens"] for r in out)])
    assert [r["start"] for r in out] == starts[:-1].tolist()
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in out]
    assert ids == sorted(ids)
    texts = {r[0]: r[1] for r in odd_rows}
    pieces = token_files.read_token_files(spark, path).filter("doc_id IS NOT NULL").orderBy("part", "doc_order", "first_token").collect()
    read = defaultdict(bytes)
    for piece in pieces:
        read[piece["part"], piece["doc_order"], piece["doc_id"]] += bytes(piece["ids"])
    for (_, _, doc), raw in read.items():
        assert tokenizer.decode(np.frombuffer(raw, "<u4")[:-1].tolist(), skip_special_tokens=False) == (texts[doc] or "")


def test_damaged_token_file(spark, odd_docs):
    path = scratch_path(spark, "files")
    token_files.write_token_files(odd_docs, path, public_tokenizers.path("byte_bpe_50k.json"), 50_257)
    blocks = spark.read.parquet(f"{path}/blocks")
    other = scratch_path(spark, "damaged")
    blocks.withColumn("payload", F.concat(F.expr("substring(payload, 1, 8)"), F.lit(b"\1"), F.expr("substring(payload, 10)"))).write.parquet(f"{other}/blocks")
    spark.read.parquet(f"{path}/frequencies").write.parquet(f"{other}/frequencies")
    with pytest.raises(Exception, match="checksum"):
        token_files.read_token_files(spark, other).collect()


def test_byte_bpe(odd_docs, odd_rows):
    import base64

    import tiktoken

    file = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = merge_replay.encode_documents(odd_docs, file, public_tokenizers.PATTERN)
    out = merge_replay.decode_documents(encoded, file).collect()
    wanted = [(r[0], coder.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in odd_rows]
    assert as_sorted((r["doc_id"], list(r["ids"]), bytes(r["content"])) for r in out) == as_sorted(wanted)


def test_quality_of_odd_rows(spark, odd_docs, odd_rows):
    marks = [(i, i % 2) for i in range(30)] + [(None, 1), (3, None), (5, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    out = pairwise_quality.quality_scores(odd_docs, labels, steps=20).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in odd_rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out)
    assert all(r["held_out"] == (bucket(r["doc_id"], 5) == 0) for r in out)
    same = pairwise_quality.quality_scores(odd_docs, labels.filter("quality = 1")).collect()
    assert {r["score"] for r in same} == {1.0}
    assert {r["score"] for r in pairwise_quality.quality_scores(odd_docs, labels.limit(0)).collect()} == {0.5}


def test_language_of_odd_rows(spark, odd_docs, odd_rows):
    out = string_kernel.predict_languages(odd_docs).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in odd_rows)
    assert all(r["held_out"] == (bucket(r["doc_id"], 4) == 2) for r in out)
    text = dict(id_texts(odd_rows))
    for r in out:
        letters = r["doc_id"] is None or any(c.isalpha() for c in text[r["doc_id"]] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    emoji = odd_docs.limit(1).withColumn("text", F.lit("\U0001f600 123 \U0001f601")).unionByName(odd_docs)
    assert string_kernel.predict_languages(emoji).filter("lang_pred = 'und'").count() == 1 + sum(r["lang_pred"] == "und" for r in out)
    none = string_kernel.predict_languages(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}


@pytest.mark.parametrize("languages, each", [(4, 2), (45, 12), (140, 4), (230, 3)])
def test_each_language_is_learned(spark, languages, each):
    """Every language has letters of its own; some have one or two learning texts."""
    rows = []
    for n in range(languages):
        letters = [chr(0x4E00 + 40 * n + i) for i in range(40)]
        for k in range(each + 1):
            words = [letters[(i * (k + 3) + k) % 40] + letters[(i + k) % 40] for i in range(60)]
            rows.append((len(rows), " ".join(words), f"x{n:03d}"))
    out = string_kernel.predict_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    held = {r["doc_id"]: r["held_out"] for r in out}
    learned = {lang for d, _, lang in rows if not held[d]}
    named = {r["doc_id"]: r["lang_pred"] for r in out}
    wrong = [d for d, _, lang in rows if lang in learned and named[d] != lang]
    assert len(learned) > 0.9 * languages and len(wrong) <= 0.01 * len(rows)


def test_languages_of_rows_without_id(spark):
    """Rows without an id, and equal rows, are drawn from like others; a text of unknown letters gets the most frequent language."""
    words = {"ru": "дом лес река поле небо ветер вода камень", "el": "σπίτι δάσος ποτάμι ουρανός νερό πέτρα"}
    rows = [(None, " ".join(words["ru"].split()[i % 7 :]) + f" {i}", "ru") for i in range(3000)]
    rows += [(i, " ".join(words["el"].split()[i % 5 :]), "el") for i in range(40)] + [(77, words["el"], "el")] * 900
    docs = spark.createDataFrame([*rows, (5000, "ภาษาไทย", None), (5001, "12", None)], "doc_id long, text string, lang string")
    out = string_kernel.predict_languages(docs).collect()
    named = defaultdict(set)
    for r in out:
        named["none" if r["doc_id"] is None else r["doc_id"]].add(r["lang_pred"])
    assert named["none"] == {"ru"} and named[77] == {"el"} and named[5000] == {"ru"} and named[5001] == {"und"}
    assert [r["score"] for r in out if r["doc_id"] == 5000] == [0.0]


def test_labelled_rows_are_bounded(spark, monkeypatch):
    """One labelled id on many rows gives one row to fit."""
    seen = []
    plain_fit = pairwise_quality.fit_pairs
    monkeypatch.setattr(pairwise_quality, "fit_pairs", lambda f, *rest: seen.append(len(f)) or plain_fit(f, *rest))
    docs = spark.createDataFrame([(i % 7 + 1 if i < 700 else 1, f"words {i} and {i % 13}") for i in range(9000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 8)] + [(2, 0)], "doc_id long, quality int")
    assert pairwise_quality.quality_scores(docs, labels, max_labelled=50).count() == 9000
    assert seen and seen[0] <= 8


def test_vectors_of_several_lengths(spark):
    rows = [(i, [0.6, 0.8], 1) for i in range(3)] + [(10 + i, [0.6, 0.8, 0.0], 1) for i in range(4)] + [(20, [0.6, 0.8], 2)]
    out = cap_filters.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out} == {
        **{i: (2, 0) for i in range(3)}, **{10 + i: (3, 10) for i in range(4)}, 20: (0, 20)
    }


def test_each_language_keeps_ngrams():
    sets = [np.arange(i % 5, 900, dtype=np.int32) for i in range(20)] + [np.arange(2000, 2300, dtype=np.int32)]
    kernel = string_kernel.PresenceKernel.fit(sets, ["a"] * 20 + ["b"], 3, 100)
    assert kernel.width == 100 and (kernel.column[2000:2300] >= 0).sum() == 50


def test_no_rows(spark, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert chunk_dedup.exact_dedup(no_docs).count() == 0
    assert line_dedup.apply_line_bitmaps(no_docs, line_dedup.recurring_line_bitmaps(no_docs)).count() == 0
    assert sharding.interleaved_shards(no_docs).count() == 0
    assert simhash_grid.near_duplicates(no_docs).count() == 0
    assert source_schedule.mix_sources(no_docs).count() == 0
    assert pairwise_quality.quality_scores(no_docs, labels).count() == 0
    assert string_kernel.predict_languages(no_docs).count() == 0
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = merge_replay.encode_documents(no_docs, ranks, public_tokenizers.PATTERN)
    assert merge_replay.decode_documents(encoded, ranks).count() == 0
    path = scratch_path(spark, "files")
    token_files.write_token_files(no_docs, path, public_tokenizers.path("byte_bpe_50k.json"), 50_257)
    assert token_files.document_checksums(spark, path).count() == 0
