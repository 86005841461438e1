import random
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.columns import TIME_FORMATS, json_text, parse_boolean, parse_timestamp, rename_json_key
from ledgerloom.operators import cleaning as rules
from ledgerloom.operators.key_index import BUCKET, KeyIndex
from ledgerloom.operators.keys import repair_duplicates, resolve_conflicts, row_digest
from ledgerloom.plans.cleaners import clean_table
from ledgerloom.schemas import ORDERS, USERS
from ledgerloom.session import compiled_methods

T = datetime(2026, 4, 1, 10, 5, 7)


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2026-04-01 10:05:07", T),
        ("2026-4-1 10:5:7", T),
        ("2026/04/01 10:05", T.replace(second=0)),
        ("01-04-2026 10:05", T.replace(second=0)),
        ("20260401100507", T),
        ("2026-04-01", datetime(2026, 4, 1)),
        ("2026/04/01", datetime(2026, 4, 1)),
        ("2026-04-01 10:05", T.replace(second=0)),
        ("20260401", datetime(2026, 4, 1)),
        ("01/04/2026 10:05", T.replace(second=0)),
        ("2026-04-01T10:05:07", T),
        ("  2026-04-01 10:05:07 ", T),
        ("2026/04/01 10:05:07", None),
        ("0000-00-00 00:00:00", None),
        ("not_a_date", None),
        ("null", None),
        ("", None),
        (None, None),
        ("2026-02-30", None),
        ("2026-13-01", None),
        ("2026-04-01 25:00:00", None),
        ("2026040110", None),
    ],
)
def test_time_spellings(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_timestamp(F.col("t"))).first()[0] == expected


def test_boolean_spellings(spark):
    cells = [("True", 1), (" y ", 1), ("1", 1), ("no", 0), ("F", 0), ("0.0", 0), ("3", 1), ("maybe", 0), ("", 0), (None, 0)]
    df = spark.createDataFrame(cells, "t string, want int")
    assert df.filter(parse_boolean(F.col("t")) != F.col("want")).count() == 0
    assert df.filter("t = 'maybe'").select(parse_boolean(F.col("t"), default=True)).first()[0] == 1


def test_json_cells(spark):
    df = spark.createDataFrame([('{"a": [1, 2]}',), ("half off",), ('say "hi"',), (None,)], "t string")
    assert [r[0] for r in df.select(json_text(F.col("t"))).collect()] == ['{"a":[1,2]}', '"half off"', '"say \\"hi\\""', None]


def test_rename_reaches_every_depth_but_no_values(spark):
    text = '{"k":1,"in":[{"k" : "k"},{"x\\"k":2}],"note":"\\"k\\":"}'
    df = spark.createDataFrame([(text,)], "t string")
    renamed = df.select(rename_json_key(F.col("t"), "k", "z")).first()[0]
    assert renamed == '{"z":1,"in":[{"z" : "k"},{"x\\"k":2}],"note":"\\"k\\":"}'


def test_missing_required_column_stops(spark):
    with pytest.raises(rules.MissingColumns):
        rules.project(spark.createDataFrame([("a",)], "user_id string"), USERS.columns, USERS.required)


def test_empty_result_stops(spark):
    with pytest.raises(rules.EmptyResult):
        rules.ensure_not_empty(spark.range(0), "users")


def brute_force_repair(ids):
    """First keeps the id, the n-th repeat takes the next free number from n on."""
    taken, seen, out = set(ids), {}, []
    for i in ids:
        seen[i] = seen.get(i, 0) + 1
        if seen[i] == 1:
            out.append(i)
            continue
        n = seen[i] - 1
        while f"{i}_dup{n}" in taken:
            n += 1
        taken.add(f"{i}_dup{n}")
        out.append(f"{i}_dup{n}")
    return out


@pytest.mark.parametrize("seed", range(4))
def test_duplicate_repair_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = ["A", "B", "A_dup1", "A_dup2", "A_dup5", "A_dup01", "B_dup3", "A_dup1_dup1", "C"]
    ids = [rng.choice(pool) for _ in range(60)]
    df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "id string, n int")
    fixed = [r.id for r in repair_duplicates(df, "id", row_digest(["n", "id"])).collect()]
    # which repeat gets which number depends on the row order, the set of ids does not
    assert sorted(fixed) == sorted(brute_force_repair(ids))
    assert len(set(fixed)) == len(ids)


def test_hot_key_is_numbered_without_gaps(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    fixed = repair_duplicates(df, "k", row_digest(["id"]))
    hot = fixed.filter(F.col("k").startswith("hot_dup")).select(F.substring_index("k", "_dup", -1).cast("int").alias("n"))
    low, high, distinct, count = hot.agg(F.min("n"), F.max("n"), F.countDistinct("n"), F.count("n")).first()
    assert (low, high) == (1, count) and distinct == count == 6666


def test_stored_conflicts_take_the_first_free_number(spark):
    batch = spark.createDataFrame([("a",), ("b",), ("c",), ("b_new1",), ("d",)], "id string")
    stored = spark.createDataFrame([("a",), ("a_new1",), ("a_new3",), ("b",), ("d",), ("d_new2",), ("x_new1",)], "id string")
    fixed = sorted(r.id for r in resolve_conflicts(batch, "id", stored).collect())
    assert fixed == ["a_new2", "b_new1", "b_new2", "c", "d_new1"]


def test_clean_plus_rejected_is_input(spark):
    users = spark.createDataFrame([("u1",)], "user_id string")
    products = spark.createDataFrame([("p1",)], "product_id string")
    promotions = spark.createDataFrame([("x",)], "promotion_id string")
    good = dict(order_id="1", user_id="u1", product_id="p1", order_amount="2.5", order_status="PAID", order_time="2026-04-01")
    rows = [
        good,
        {**good, "order_status": "lost"},
        {**good, "user_id": "u2"},
        {**good, "order_time": "0000-00-00 00:00:00"},
        {**good, "order_id": " "},
        {**good, "order_amount": "many"},
        {**good, "promotion_id": "x"},
        {**good, "promotion_id": "y"},
    ]
    raw = spark.createDataFrame([tuple(r.get(c) for c in ORDERS.columns) for r in rows], ORDERS.raw_schema())
    refs = {"users": users, "dim_products": products, "dim_promotions": promotions}
    result = clean_table(raw, ORDERS, refs)
    assert sorted((r.rule, r.column_name) for r in result.rejected.collect()) == [
        ("enum", "order_status"),
        ("foreign_key", "promotion_id"),
        ("foreign_key", "user_id"),
        ("not_null", "order_id"),
        ("timestamp", "order_time"),
        ("type", "order_amount"),
    ]
    kept = result.rows.collect()
    assert sorted(r.order_id for r in kept) == ["1", "1_dup1"]
    assert {r.order_status for r in kept} == {"paid"}
    # the strict form also wants coupon, address, all times and a promotion
    assert clean_table(raw, ORDERS, refs, strict=True).rows.count() == 0


def test_rows_that_are_equal_in_all_columns(spark):
    """Most rows are one row many times over; used numbers in between are skipped."""
    rows = [("a", "x")] * 25_000 + [("a", "y")] * 3 + [("a_dup2", "x"), ("a_dup7", "x"), ("line\nbreak", "x"), ("line\nbreak", "y"), ("line\nbreak_dup1", "z")]
    df = spark.createDataFrame(rows, "id string, v string")
    for digits in (1, 2):
        out = repair_duplicates(df, "id", row_digest(["id", "v"]), bucket_digits=digits)
        ids = {r.id for r in out.collect()}
        numbers = [n for n in range(1, 25_005) if n not in (2, 7)][:25_002]
        assert out.count() == len(rows) == len(ids)
        assert ids == {"a", *(f"a_dup{n}" for n in numbers), "a_dup2", "a_dup7", "line\nbreak", "line\nbreak_dup1", "line\nbreak_dup2"}


def test_own_naming_of_repeats(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1)], "id string, v int")
    named = repair_duplicates(df, "id", row_digest(["id", "v"]), make_id=lambda key, n: F.concat(F.lit("#"), n.cast("string"), key))
    assert {r.id for r in named.collect()} == {"a", "#1a", "#2a", "b"}


def test_renamed_json_keys_are_literal(spark):
    df = spark.createDataFrame([('{"a.b": 1, "axb": 2, "$1": {"a.b" : "a.b"}}',)], "j string")
    out = df.select(rename_json_key(F.col("j"), "a.b", "p$1\\").alias("x"), rename_json_key(F.col("j"), "$1", "q").alias("y")).first()
    assert out.x == '{"p$1\\\\": 1, "axb": 2, "$1": {"p$1\\\\" : "a.b"}}'
    assert out.y == '{"a.b": 1, "axb": 2, "q": {"a.b" : "a.b"}}'


@pytest.mark.parametrize("stamp", [2, 3, 4])
def test_key_index_equals_a_scan(spark, tmp_path, stamp):
    chance = np.random.default_rng(stamp)
    kinds = [*"abcdef", "", "x\ny"]

    def some(n):
        numbers = chance.integers(0, 9, n)
        return sorted({str(chance.choice(kinds)) + ("" if k < 3 else f"_new{k - 2}") + ("_new2" if k == 7 else "") for k in numbers})

    loads = {date(2024, 1, d): some(30) for d in (1, 2, 3)}
    index = KeyIndex(spark, str(tmp_path / "index"), buckets=4)
    frame = lambda ids: spark.createDataFrame([(i,) for i in ids], "id string")
    batch = frame(some(40)).cache()
    assert sorted(r.id for r in index.resolve(batch, "id").collect()) == sorted(r.id for r in batch.collect())
    for day, ids in loads.items():
        index.add(frame([*ids, "gone", "gone_new1"]), "id", day)
        index.add(frame(ids), "id", day)  # a repeat replaces its earlier try
    for but in (None, date(2024, 1, 2)):
        old = frame([i for day, ids in loads.items() if day != but for i in ids])
        wanted = sorted(r.id for r in resolve_conflicts(batch, "id", old).collect())
        assert sorted(r.id for r in index.resolve(batch, "id", but=but).collect()) == wanted
    # an index of a table that was stored without one
    late = KeyIndex(spark, str(tmp_path / "late"), buckets=4)
    late.build(spark.createDataFrame([(i, day) for day, ids in loads.items() for i in ids], "id string, load_date date"), "id")
    wanted = sorted(tuple(r) for r in spark.read.parquet(index.path).select("base", "first", "last").collect())
    assert sorted(tuple(r) for r in spark.read.parquet(late.path).select("base", "first", "last").collect()) == wanted


def test_key_index_reads_only_its_folders(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "index"), buckets=16)
    index.add(spark.range(500).selectExpr("concat('u', id) AS id"), "id", date(2024, 1, 1))
    batch = spark.createDataFrame([("u1",), ("u1_new1",), ("other",)], "id string")
    plan = index.entries(batch)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    files = lambda df: df.select(F.input_file_name()).distinct().count()
    assert BUCKET in filters and files(index.entries(batch)) <= 3 < files(spark.read.parquet(index.path))
    assert sorted(r.id for r in index.resolve(batch, "id").collect()) == ["other", "u1_new1", "u1_new2"]
    named = index.resolve(batch, "id", make_id=lambda i, n: F.concat(F.lit("fresh-"), i))
    assert sorted(r.id for r in named.collect()) == ["fresh-u1", "other", "u1_new1"]


def test_two_parsers_read_all_spellings(spark):
    """A cell is tried by two parsers and one cast, and reads as by a parser for each spelling."""
    cells = ["2024-1-2 3:4:5", "2024/1/2 3:4", "2-1-2024 3:4", "20240102030405", "2024-1-2", "2024/1/2", "2024-1-2 3:4", "20240102", "2/1/2024 3:4", "2024-1-2T3:4:5"]
    bad = ["2024/1/2 3:4:5", "2-1/2024 3:4", "2024-1-2T3:4", "2024-13-2", "2024-02-30", "2024-1-2 24:00", "2024-1-2 3:4:60", "0000-00-00 00:00:00"]
    bad += ["2024-1-2\n", "2024-1-2Z", "2024-1-2  3:4", "2-1-2024", "2024010203", "24-1-2", "2024-1-2 3", "x2024-1-2", "", "10000-1-1"]
    df = spark.createDataFrame([(c,) for c in [*cells, *[f" {c} " for c in cells], *bad, None]], "t string").repartition(2)
    each = F.coalesce(*[F.when(F.trim("t").rlike(s), F.try_to_timestamp(F.trim("t"), F.lit(p))) for s, p in TIME_FORMATS])
    both = df.select("t", parse_timestamp(F.col("t")).alias("new"), each.alias("each"))
    assert both.filter("new IS NOT NULL").count() == 2 * len(cells)
    assert both.filter("NOT (new <=> each)").collect() == []
    expression = df.select(parse_timestamp(F.col("t")).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert expression.lower().count("gettimestamp(") <= 2


def test_rows_are_not_shuffled_to_find_a_few_repeated_ids(spark):
    rows = spark.range(5000).select(F.concat(F.lit("k"), F.when(F.col("id") < 3, 0).otherwise(F.col("id"))).alias("k"), F.col("id").cast("string").alias("v"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # the rows are larger than what is broadcast, the one repeated id is not
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        fixed = repair_duplicates(rows, "k", row_digest(["k", "v"]))
        text = fixed._jdf.queryExecution().executedPlan().toString()
        found = {r.k for r in fixed.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    anti = [line for line in text.splitlines() if "LeftAnti" in line]
    assert anti and all("BroadcastHashJoin" in line for line in anti)
    assert len(found) == 5000 and {"k0", "k0_dup1", "k0_dup2", "k4999"} <= found


def test_the_code_limit_is_put_back(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with compiled_methods(spark):
        assert spark.conf.get(name) == "8000"
    assert spark.conf.get(name) == before
