"""Carried totals: any order of loads gives what counting anew gives, and no other folder is read."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from ledgerloom.operators.carried import CarriedTotals
from ledgerloom.plans.lifetime import loads, product_part, user_part
from ledgerloom.plans.product_summary import product_summary, product_summary_days
from ledgerloom.session import scratch_path
from ledgerloom.sources.samples import sample_warehouse
from verification.compare import difference
from verification.lifetime_queries import DAY, DAYS, stored_loads

FIRST = date(2001, 1, 1)
SCHEMA = "k string, n long, money decimal(24,2), last timestamp"


def table(spark, keep=35):
    path = scratch_path(spark, "totals")
    return CarriedTotals(spark, path, ["k"], {"n": "bigint", "money": "decimal(24,2)"}, {"last": "timestamp"}, keep)


def counted(parts, upto):
    """Plain totals over a dict of day -> rows."""
    out = {}
    for day, rows in parts.items():
        if day <= upto:
            for k, n, money, last in rows:
                a, b, c = out.get(k, (0, 0, datetime.min))
                out[k] = (a + n, b + money, max(c, last))
    return out


def read(totals, day):
    return {r["k"]: (r["n"], float(r["money"]), r["last"]) for r in totals.totals(day).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_loads(spark, seed):
    """Loads in order, repeats with other rows, late loads, an emptied load, NULL keys."""
    draw, totals, parts = random.Random(seed), table(spark), {}

    def load(day, size):
        rows = []
        for _ in range(size):
            moment = datetime(2001, 1, 1) + timedelta(hours=draw.randrange(5000))
            rows.append((draw.choice([None, "a", "b", "c", f"d{draw.randrange(30)}"]), draw.randrange(1, 5), draw.randrange(100), moment))
        parts[day] = rows
        typed = spark.createDataFrame([(k, n, str(m), t) for k, n, m, t in rows], "k string, n long, money string, last timestamp")
        totals.advance(day, typed.withColumn("money", F.col("money").cast("decimal(24,2)")))

    steps = [(0, 20), (1, 10), (4, 10), (1, 8), (2, 9), (5, 12), (0, 6), (4, 0)]
    for nth, size in steps:
        load(FIRST + timedelta(days=nth), size)
    for day in totals.versions():
        assert read(totals, day) == counted(parts, day), day
    last = max(parts)
    before = read(totals, last)
    totals.rebuild(last)
    assert read(totals, last) == before


def test_old_totals_go(spark):
    totals = table(spark, keep=2)
    for n in range(4):
        totals.advance(FIRST + timedelta(days=n), spark.createDataFrame([("a", 1, None, None)], SCHEMA))
    assert totals.versions() == [FIRST + timedelta(days=2), FIRST + timedelta(days=3)]
    # a load whose own totals are gone still counts in those that are kept
    totals.advance(FIRST, spark.createDataFrame([("a", 5, None, None)], SCHEMA))
    assert [read_n(totals, d) for d in totals.versions()[-2:]] == [7, 8]


def read_n(totals, day):
    return totals.totals(day).first()["n"]


def test_a_day_reads_its_own_folders(spark):
    """The facts of one load, the totals of one day and one earlier part: partition filters on all three."""
    wh = stored_loads(sample_warehouse(spark, SMALL), scratch_path(spark, "loads"))
    load = loads(wh, DAYS[2], DAYS[3])
    files = {f.split("load_date=")[1][:10] for f in load.orders.inputFiles()}
    assert len(files) > 3  # all are known to the reader ...
    text = user_part(load)._jdf.queryExecution().executedPlan().toString()
    assert text.count("PartitionFilters: [isnotnull(load_date") == 2  # ... and one load is read
    totals = table(spark)
    for n in range(3):
        totals.advance(FIRST + timedelta(days=n), spark.createDataFrame([("a", 1, None, None)], SCHEMA))
    new = totals.summed(spark.createDataFrame([("a", 2, None, None)], SCHEMA))
    plan = totals.corrected(new, FIRST + timedelta(days=3))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(as_of") == 1 and "2001-01-02" not in plan


def test_range_of_days_is_each_day(spark):
    """The one-pass table has for each day what a run over the facts up to that day counts."""
    from dataclasses import replace

    wh = sample_warehouse(spark, SMALL)
    days = [DAY - timedelta(days=n) for n in (9, 4, 0)]
    at_once = product_summary_days(wh, days[0], days[-1]).cache()
    for day in days:
        upto = F.lit(day + timedelta(days=1)).cast("timestamp")
        known = replace(wh, orders=wh.orders, returns=wh.returns.filter(F.col("apply_time") < upto))
        own = product_summary(replace(known, orders=known.orders.filter(F.col("order_time") < upto)), day)
        one = at_once.filter(F.col("stat_date") == F.lit(day)).select(*own.columns)
        assert difference(own.toPandas(), one.toPandas()) is None


def test_a_load_does_not_shuffle_all_orders(spark):
    """A stored table is as large as all its folders to Spark; the few returns of one load are broadcast nevertheless."""
    wh = stored_loads(sample_warehouse(spark, SMALL), scratch_path(spark, "loads"))
    load = loads(wh, DAYS[2], DAYS[3])
    whole = int(str(wh.returns.select("order_id")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # Spark has to tell the load's returns from the whole table by their size, as at scale
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(whole // 2))
    try:
        text = product_part(load, wh.orders)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
