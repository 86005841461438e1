"""What the physical plans must and must not contain."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from ledgerloom.functions.months import ReportMonths
from ledgerloom.operators.latest import latest_snapshot, with_latest
from ledgerloom.plans.business_health import business_health
from ledgerloom.plans.daily_sales import daily_sales
from ledgerloom.schemas import USER_ACTIONS
from ledgerloom.sources.samples import SampleTables, sample_warehouse
from ledgerloom.sources.tables import append_clean, stored
from verification.cleaning_queries import cleaned
from verification.model_queries import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_models_stay_in_the_jvm_and_avoid_products(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "Python" not in text and "Pandas" not in text
    assert "CartesianProduct" not in text


def test_scan_reads_only_needed_columns(spark):
    text = plan(business_health(sample_warehouse(spark, SMALL)))
    assert "l_shipdate" not in text and "l_tax" not in text


def test_stored_facts_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "actions")
    append_clean(cleaned(SampleTables(spark, SMALL), "user_actions").rows, path, USER_ACTIONS)
    wh = sample_warehouse(spark, SMALL)
    from dataclasses import replace

    day = date(2024, 1, 5)
    text = plan(business_health(replace(wh, actions=stored(spark, path)), day, day))
    assert "PartitionFilters: [isnotnull(event_date" in text.replace("\n", " ")
    assert "PushedFilters" in text


def test_large_dimensions_are_merged_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(daily_sales(sample_warehouse(spark, SMALL)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_promotions_look_levels_up_without_a_join_by_month(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["ads_platform_promotion_detail"](spark, SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # neither the months of all users are shuffled, nor are orders counted again for those without a promotion
    assert not re.search(r"hashpartitioning\(stat_month#\d+, user_id#\d+, \d+\)", text)
    assert len(re.findall(r"HashAggregate\(keys=\[[^]]*promotion_id#\d+[^]]*\], functions=\[partial_sum\(order_amount", text)) == 1


@pytest.mark.parametrize("last", [date(2024, 6, 1), date(2024, 2, 1)])
def test_facts_get_the_newest_snapshot_of_their_month(spark, last):
    months = ReportMonths(date(2024, 2, 1), last)
    rows = [
        ("a", date(2023, 12, 5), "old"),  # before the first month
        ("a", date(2024, 3, 1), "first of the month"),
        ("a", date(2024, 3, 2), "april"),
        ("a", date(2024, 3, 31), "later in april"),
        ("a", date(2024, 4, 1), None),  # a known NULL is no gap
        ("b", date(2024, 5, 20), "june"),
        (None, date(2024, 1, 1), "nobody"),
    ]
    profile = spark.createDataFrame(rows, "user_id string, stat_date date, user_level string")
    asked = [(u, date(2024, m, 1), m, n) for u in ("a", "b", "c", None) for m in range(2, 7) for n in (1, 1, None)]
    facts = spark.createDataFrame([x for x in asked if x[1] <= last], "user_id string, stat_month date, m int, n int")
    wanted = facts.join(latest_snapshot(profile, "user_id", ["user_level"], months), ["stat_month", "user_id"], "left")
    found = with_latest(facts, profile, "user_id", ["user_level"], months).select(wanted.columns)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))
    levels = {(r["user_id"], r["m"]): r["user_level"] for r in found.collect()}
    assert levels["a", 2] == "old" and levels[None, 2] is None and levels["b", 2] is None
    assert last.month == 2 or (levels["a", 3], levels["a", 4], levels["b", 6]) == ("first of the month", None, "june")


def test_top_products_keep_few_rows_before_the_shuffle(spark):
    text = plan(QUERIES["ads_merchant_monthly_snapshot"](spark, SMALL))
    assert "WindowGroupLimit" in text


def test_unknown_history_is_refused(spark):
    wh = sample_warehouse(spark, SMALL)
    with pytest.raises(ValueError):
        business_health(wh, history=wh.orders.select(F.lit(1)))
