"""Pieces of the operators by themselves."""

import base64
import math

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zlib

from ledgerloom.llm import token_files
from ledgerloom.llm.cap_filters import CapFilters, enough_filters, near_vectors, pairs_at, unmet
from ledgerloom.llm.components import connected_components
from ledgerloom.llm.merge_replay import MergeReplay, read_ranks
from ledgerloom.llm.simhash_grid import close_links, grid_groups, segment_counts
from ledgerloom.llm.token_words import WordMemo
from plain import components, vector_links


def test_coder_round_trip():
    random = np.random.default_rng(1)
    ids = (random.pareto(0.6, 150_000) * 3).astype(np.int64) % 5000
    coder = token_files.SharedTable(token_files.scaled_frequencies(np.bincount(ids, minlength=6000)))
    blocks = [ids[:65_536], ids[65_536:131_072], ids[131_072:], ids[:1], ids[:8192], ids[:8193]]
    coded = coder.encode(blocks)
    back = coder.decode([(*c, len(b)) for c, b in zip(coded, blocks, strict=True)])
    assert all((a == b).all() for a, b in zip(back, blocks, strict=True))
    counts = np.bincount(ids)
    share = counts[counts > 0] / len(ids)
    entropy = -(share * np.log2(share)).sum() * 65_536 / 8
    assert len(coded[0][0]) < 1.02 * entropy
    # one segment alone, from its checkpoint
    payload, states, offsets = coded[1]
    lone = (payload, states[3 * 512 : 4 * 512], offsets[12:16], 8192)
    with pytest.raises(ValueError):
        coder.decode([lone])  # not the block's end, so the last state is another
    two = coder.decode([(payload, states[7 * 512 :], offsets[28:], 8192)])[0]
    assert (two == blocks[1][7 * 8192 :]).all()


def test_known_words_stay_in_the_worker(spark, tmp_path, monkeypatch):
    seen = tmp_path / "kept"

    def keep(key, build, path=str(seen)):
        made = build()
        with open(path, "a") as out:
            out.write(f"{type(made).__name__}\n")
        return made

    monkeypatch.setattr(token_files, "kept_in_worker", keep)
    docs = spark.createDataFrame([(1, "some words, some words\nagain")], "doc_id long, text string").coalesce(1)
    vocabulary = str(public_tokenizers.path("byte_bpe_50k.json"))
    assert len(token_files.tokenize(docs, vocabulary, 0, "<u2").collect()) == 1
    assert set(seen.read_text().split()) == {"WordMemo"}  # not the vocabulary alone


def library_memo(encoded: list[str]):
    """A WordMemo over the library's encoder that notes the strings given to it; and the tokenizer."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = token_files.library_encoder(tokenizer, "<u2")

    def noting(strings):
        encoded.extend(strings)
        return encode(strings)

    return WordMemo(noting, "<u2"), tokenizer


def ids_by_text(memo, texts: list[str | None]) -> list[list[int]]:
    out = []
    for at, part, ids, counts in memo.ids(pa.array(texts, pa.string())):
        assert at == len(out) and len(part) == len(counts)
        out += [own.tolist() for own in np.split(ids, np.cumsum(counts)[:-1])]
    return out


def test_each_piece_is_encoded_once():
    encoded = []
    memo, tokenizer = library_memo(encoded)
    encoded.clear()
    texts = ["Some cat, every dog.\nEvery cat! And every dog"] * 500 + ["Some dog.\nEvery cat, and every dog; every cat"] * 500
    assert ids_by_text(memo, texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(encoded) <= 15  # the first words of all texts are one string, too
    ids_by_text(memo, texts)
    assert len(encoded) <= 15


def test_words_cut_like_the_library():
    import random

    memo, tokenizer = library_memo([])
    signs = [" ", " ", " ", "\n", "\n", "a", "the", "B", "é", "字", "ª", "𝔸", "\u0301", "1", "٣", ".", "!", "'", "'s", "|", "-", "\t", "\r", "\u00a0", "\x1c", "\u2028"]
    fixed = [None, "", " ", "\n", "a\nb", "a \nb", "a\n b", "a\n\nb", "\na", "\n\na", "a\r\nb", "a\n\tb", "a b\n", "the.\nthe,\n1.", "x \nthe the\nthe", "a <|endoftext|>\nb.", "3. a1.", "##. a"]
    for seed in range(20):
        draw = random.Random(seed)
        texts = fixed + ["".join(draw.choices(signs, k=draw.randrange(1, 25))) for _ in range(300)]
        wanted = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert ids_by_text(memo, texts) == wanted


def test_checksums_pass_over_bytes():
    random = np.random.default_rng(2)
    for size in (0, 1, 7, 4096, 100_003):
        a, b = random.bytes(37), random.bytes(size)
        joined = token_files.passed_on(np.array([zlib.crc32(a)], np.uint32), np.array([size]))[0] ^ zlib.crc32(b)
        assert joined == zlib.crc32(a + b)


def test_frequencies_keep_every_symbol():
    counts = np.zeros(50_257, np.int64)
    counts[:40_000] = 1
    counts[7] = 10**12
    scaled = token_files.scaled_frequencies(counts)
    assert scaled.sum() == 1 << 20 and (scaled[:40_000] >= 1).all() and (scaled[40_000:] == 0).all()


def test_merge_replay_against_tiktoken():
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken")) as file:
        tokens = read_ranks(file.read())
    replay = MergeReplay(tokens)
    coder = tiktoken.Encoding("own", pat_str="[^|]+", mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    random = np.random.default_rng(3)
    words = ["a" * n for n in range(1, 40)] + ["ab" * n for n in range(1, 20)] + ["aab" * 30, "日本語", "éé", "the" * 200]
    words += ["".join(random.choice(list("abeht inr"), random.integers(1, 40))) for _ in range(500)]
    coded = [np.frombuffer(r, "<i4").tolist() for r in replay.encode([w.encode() for w in words])]
    assert coded == [coder.encode_ordinary(w) for w in words]
    assert [replay.alone(w.encode()) for w in words[:60]] == coded[:60]


def test_ranks_that_open_lower_ones():
    """A vocabulary in which a merge makes a pair of a lower rank; the word is then done by itself."""
    import tiktoken

    tokens = [bytes([b]) for b in range(256)] + [b"aba", b"ab", b"abab"]
    coder = tiktoken.Encoding("own", pat_str="[^|]+", mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    words = ["abab", "ababab", "xabaabab", "ab", "b", "aabab"]
    assert [np.frombuffer(r, "<i4").tolist() for r in MergeReplay(tokens).encode([w.encode() for w in words])] == [
        coder.encode_ordinary(w) for w in words
    ]


def test_rank_file():
    lines = "\n".join(f"{base64.b64encode(t).decode()} {i}" for i, t in [(1, b"b"), (0, b"a")])
    assert read_ranks(lines) == [b"a", b"b"]


def test_components(spark):
    random = np.random.default_rng(4)
    links = [(int(a), int(b)) for a, b in random.integers(0, 400, (300, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    links += [(5000, 5001 + i) for i in range(200)] + [(7, 7), (1001, 1000)]
    out = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    linked = [(a, b) for a, b in links if a != b]
    wanted = components({n for pair in linked for n in pair}, linked)
    assert {r["node"]: r["root"] for r in out} == wanted and len(out) == len(wanted)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(
    "max_bits, meetings, crowd", [(0, 512, 8192), (1, 512, 8192), (3, 1, 8192), (4, 512, 8192), (4, 0.01, 8192), (4, 512, 3), (6, 10**9, 2)]
)
def test_grid_finds_every_close_pair(spark, max_bits, meetings, crowd):
    random = np.random.default_rng(5)
    prints = random.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = [int(p) ^ sum(1 << int(b) for b in random.choice(64, n, replace=False)) for p in prints[:200] for n in (max_bits, max_bits + 1)]
    values = sorted({int(p) for p in prints} | set(near))
    rows = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fingerprint long")
    found = [(r["high"] % (1 << 64), r["low"] % (1 << 64)) for r in close_links(rows, max_bits, meetings, crowd).collect()]
    links = [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= max_bits]
    assert components(values, found) == components(values, links)


def test_crowded_cells_are_split(spark):
    # a cluster in which all fingerprints share most cells, with batches that end inside cells
    random = np.random.default_rng(9)
    values = sorted({0x5A5A_5A5A_5A5A_5A5A ^ (1 << int(a)) ^ (1 << int(b)) for a, b in random.integers(0, 64, (700, 2))})
    rows = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fingerprint long")
    links = [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= 2]
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch, crowd in ((50, 20), (7, 64)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            found = [(r["high"] % (1 << 64), r["low"] % (1 << 64)) for r in close_links(rows, 2, crowd=crowd).collect()]
            assert components(values, found) == components(values, links)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_meetings_stay_bounded():
    # random fingerprints: those that share a cell, counted over all cells, for each fingerprint
    random = np.random.default_rng(3)
    for rows in (100_000, 400_000, 1_600_000):
        groups = grid_groups(rows, 4, meetings=16)
        counts = segment_counts(random.integers(0, 1 << 63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        bounds = np.linspace(0, 32, groups + 1).astype(int)
        columns = np.concatenate([np.arange(a, b) for a, b in zip(bounds, bounds[1:])][: groups - 4])
        cell = counts[:, columns] @ (3 ** np.arange(len(columns)))
        sizes = np.unique(cell, return_counts=True)[1]
        assert math.comb(groups, 4) * (sizes * (sizes - 1)).sum() / rows < 3 * 16, rows


def planted(dims=32, groups=40, each=4, seed=6):
    random = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = random.standard_normal(dims)
        for _ in range(each):
            rows.append((len(rows), [float(x) for x in np.float32(centre + 0.12 * random.standard_normal(dims))], g % 2))
    rows += [(len(rows) + i, rows[i][1], rows[i][2]) for i in range(10)]  # copies
    rows += [(len(rows), rows[0][1], 1 - rows[0][2]), (len(rows) + 1, rows[0][1], None), (len(rows) + 2, None, 1)]
    rows += [(len(rows), [0.0] * dims, 1), (len(rows) + 1, [float("nan")] * dims, 1), (len(rows) + 2, [None] * dims, 1)]
    return rows


@pytest.mark.parametrize("run_rows", [2048, 8])
def test_near_vectors(spark, run_rows):
    rows = planted()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = near_vectors(df, 0.93, run_rows=run_rows).collect()
    assert sorted(tuple(r) for r in out) == sorted(vector_links(rows, 0.93))


def test_one_large_group_of_near_vectors(spark):
    rows = planted(groups=1, each=150)[:150]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    wanted = sorted(vector_links(rows, 0.93))
    assert sum(r[1] for r in wanted) > 10_000
    for run_rows in (2048, 40):
        assert sorted(tuple(r) for r in near_vectors(df, 0.93, run_rows=run_rows).collect()) == wanted


def test_odd_vectors(spark):
    rows = [(None, [1.0, 0.0], 1, 7), (1, [1.0, 0.0], 1, 7), (1, [1.0, 0.0], 1, 7), (2, [1.0], 1, 7), (3, [], 1, 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node int")
    out = sorted((tuple(r) for r in near_vectors(df).collect()), key=repr)
    assert out == sorted([(None, 0, None, True), (1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True), (3, 0, 3, True)], key=repr)
    assert near_vectors(df.limit(0)).count() == 0


def test_recall_at_the_limit():
    random = np.random.default_rng(7)
    filters = CapFilters(64, 64, 3, 16, 5)
    a = random.standard_normal((800, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = random.standard_normal((800, 64))
    b -= (b * a).sum(axis=1)[:, None] * a
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * b / np.linalg.norm(b, axis=1)[:, None]
    lists = [set(zip(*map(np.ndarray.tolist, filters.listed(x)), strict=True)) for x in (a, b)]
    met = {row for row, _ in lists[0] & lists[1]}
    assert len(met) > 0.98 * 800


@pytest.mark.parametrize("codewords", [64, 260, 1100])
def test_recall_holds_as_labels_grow(codewords):
    filters = enough_filters(64, codewords, 3, 16, 5, least_cosine=0.93, most_missed=0.001)
    a, b = pairs_at(0.93, 2000, 64, np.random.default_rng(8))
    assert np.allclose((a * b).sum(axis=1), 0.93)
    assert unmet(filters, a, b).sum() <= 6


def test_recall_is_bounded_in_few_dimensions_and_at_lower_cosines():
    for dims, cosine in ((1, 0.93), (2, 0.93), (5, 0.93), (64, 0.88)):
        filters = enough_filters(dims, 64, 3, 16, 5, cosine, most_missed=0.001)
        assert unmet(filters, *pairs_at(cosine, 2000, dims, np.random.default_rng(9))).sum() <= 6
    with pytest.raises(ValueError):
        enough_filters(8, 64, 1, 0.01, 5, 0.1, most_missed=0.01, most_tables=3)
