"""What large tables leave on the disks: shuffles of whole rows that are not needed, and shuffle files that nobody reads any more."""

import os
import re
import time
from contextlib import contextmanager
from datetime import date

from conftest import SMALL
from ledgerloom.operators import cleaning as rules
from ledgerloom.plans.cleaners import check_rows, clean_table
from ledgerloom.plans.daily_reports import merchant_daily_snapshot
from ledgerloom.schemas import ORDERS
from ledgerloom.session import setting
from ledgerloom.sources.samples import SampleTables
from test_plans import plan
from verification.cleaning_queries import extract
from verification.model_queries import QUERIES

LIMIT = "spark.sql.autoBroadcastJoinThreshold"


def shuffle_files(spark) -> set[str]:
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, files in os.walk(d.getPath()) for f in files if f.startswith("shuffle_")}


@contextmanager
def no_shuffle_files_left(spark):
    before = shuffle_files(spark)
    yield
    for _ in range(100):  # they are deleted behind the job
        left = shuffle_files(spark) - before
        if not left:
            return
        time.sleep(0.1)
    raise AssertionError(sorted(left)[:5])


def orders(spark):
    """Known, unknown, blank and padded keys of users, products and promotions; broken cells before and after the look-ups."""
    good = dict(order_id="1", user_id="u1", product_id="p1", order_amount="2.5", order_status="PAID", order_time="2026-04-01")
    other = [{}, {"user_id": " u2 "}, {"user_id": "nobody"}, {"user_id": None}, {"product_id": "none"}, {"product_id": " "}]
    other += [{"promotion_id": "x"}, {"promotion_id": "y"}, {"user_id": "nobody", "order_status": "lost"}]
    other += [{"user_id": "nobody", "order_amount": "many"}, {"order_amount": "many"}, {"order_time": "never", "product_id": "none"}]
    rows = [{**good, **o, "order_id": str(n // 2)} for n, o in enumerate(other * 3)]
    raw = spark.createDataFrame([tuple(r.get(c) for c in ORDERS.columns) for r in rows], ORDERS.raw_schema())
    users = spark.range(5000).selectExpr("concat('u', id) as user_id").unionAll(spark.createDataFrame([(None,)], "user_id string"))
    products = spark.range(5000).selectExpr("concat(' p', id % 4000) as product_id")
    promotions = spark.createDataFrame([("x",)], "promotion_id string")
    return raw, {"users": users, "dim_products": products, "dim_promotions": promotions}


def lines(df):
    return sorted(map(repr, df.collect()))


def test_rows_are_not_shuffled_for_large_key_lists(spark):
    raw, refs = orders(spark)
    wanted = [lines(check_rows(raw, ORDERS, refs, strict)) for strict in (False, True)]
    with setting(spark, LIMIT, "20000"):
        found = [check_rows(raw, ORDERS, refs, strict) for strict in (False, True)]
        assert all("SortMergeJoin" not in plan(df) for df in found)
    assert [lines(df) for df in found] == wanted
    with setting(spark, LIMIT, "-1"):
        assert lines(check_rows(raw, ORDERS, refs)) == wanted[0]


def test_rows_of_a_shuffle_are_not_dealt_again(spark):
    t = SampleTables(spark, SMALL)
    refs = {"users": t["users"], "dim_products": t["dim_products"], "dim_promotions": t["dim_promotions"]}
    with setting(spark, LIMIT, "-1"):
        assert "RoundRobin" not in plan(check_rows(extract(t, "orders"), ORDERS, refs))
    assert "RoundRobin" in plan(check_rows(extract(t, "orders"), ORDERS, refs))


def test_cleaning_leaves_no_shuffle_files(spark):
    raw, refs = orders(spark)
    stored = spark.createDataFrame([("1",), ("1_new1",)], "order_id string")
    with setting(spark, LIMIT, "-1"), no_shuffle_files_left(spark):
        clean_table(raw, ORDERS, refs, stored)


def test_rejected_rows_keep_key_and_reason(spark):
    raw, refs = orders(spark)
    rows = check_rows(raw, ORDERS, refs)
    wanted = rules.rejected_rows(rows, "orders", "order_id")
    cleaned = clean_table(raw, ORDERS, refs)
    assert lines(cleaned.rejected) == lines(wanted)
    assert cleaned.rows.count() + cleaned.rejected.count() == raw.count()


def test_days_of_merchants_are_not_shuffled_for_their_names(spark):
    with setting(spark, LIMIT, "-1"):
        text = plan(QUERIES["ads_merchant_daily_snapshot"](spark, SMALL))
    assert not re.search(r"hashpartitioning\(stat_date#\d+, merchant_id#\d+, \d+\)|hashpartitioning\(merchant_id#\d+, stat_date#\d+, \d+\)", text)


def test_names_of_days_equal_a_join(spark):
    a, b, m = date(2024, 1, 1), date(2024, 2, 1), None
    days = [(d, k, n) for n, (d, k) in enumerate([(a, "x"), (a, "x"), (b, "x"), (a, "y"), (a, "z"), (a, m), (m, "x"), (m, m)])]
    daily = spark.createDataFrame(days, "stat_date date, merchant_id string, daily_sales int")
    for column in ("order_count", "customer_count", "refund_count", "sales_mom", "sales_yoy", "order_count_mom", "refund_rate"):
        daily = daily.withColumn(column, daily.daily_sales + len(column))
    daily = daily.selectExpr("*", "false as zero_sales_flag", "true as abnormal_sales_flag")
    names = [(a, "x", "first", "A"), (a, "x", "second", "B"), (b, "x", None, None), (a, "z", None, "C"), (a, m, "none", "D"), (m, "x", "never", "D"), (b, "y", "later", "A")]
    profile = spark.createDataFrame(names, "stat_date date, merchant_id string, merchant_name string, merchant_level string")
    found = merchant_daily_snapshot(daily, profile)
    wanted = daily.join(profile, ["stat_date", "merchant_id"], "left").select(found.columns)
    assert wanted.count() == len(days) + 2  # two days with two names each
    assert lines(found) == lines(wanted)


def test_names_of_merchant_months_are_staged(spark):
    text = plan(QUERIES["ads_merchant_monthly_snapshot"](spark, SMALL))
    assert "as_of" not in text


def test_months_of_merchant_years_are_staged(spark):
    text = plan(QUERIES["ads_merchant_yearly_snapshot"](spark, SMALL))
    assert "by_date" not in text and "top_products" not in text


def test_parts_of_platform_months_are_staged(spark):
    assert "lineitem" not in plan(QUERIES["ads_platform_monthly_summary"](spark, SMALL))
