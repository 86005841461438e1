"""Day by day runs on stored tables."""

from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from ledgerloom.functions.cutoffs import Cutoffs
from ledgerloom.operators.links import due_reports
from ledgerloom.operators.quality import QualityError, gate, warehouse_alerts
from ledgerloom.plans.business_health import business_health
from ledgerloom.plans.daily_run import KEYS, EmptyResult, Store, backfill, build_day, clean_day
from ledgerloom.plans.daily_sales import daily_sales
from ledgerloom.plans.merchant_daily import merchant_daily
from ledgerloom.plans.user_profile import user_profile
from ledgerloom.schemas import SPECS
from ledgerloom.sources.extracts import read_extract, write_extract
from ledgerloom.sources.samples import SampleTables, sample_warehouse
from ledgerloom.sources.tables import stored, untouched_rows, upsert
from verification.compare import difference
from verification.dirty import EXTRACTS
from verification.model_queries import Models

EVE, NEW_YEAR = date(1998, 12, 31), date(1999, 1, 1)


@pytest.fixture(scope="module")
def wh(spark):
    return sample_warehouse(spark, SMALL)


def rows(df):
    return df.select(*sorted(df.columns)).toPandas()


def same(a, b):
    assert difference(rows(a), rows(b.select(*a.columns))) is None


def test_calendar():
    names = lambda d: sorted(r.name for r in due_reports(d))
    assert names(date(2001, 5, 2)) == ["merchant_daily", "platform_daily"]
    assert len(names(date(2001, 5, 1))) == 5 and len(names(NEW_YEAR)) == 8


def test_two_days_then_rerun(spark, wh, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    ids = {n: f"p{n}" for n in range(2, 10)}
    build_day(wh, store, EVE, "https://reports.example", ids)
    build_day(wh, store, NEW_YEAR, "https://reports.example", ids)
    # a run of days equals the range computed at once
    days = store.get("dws_merchant_daily")
    assert {r[0] for r in days.select("stat_date").distinct().collect()} == {EVE, NEW_YEAR}
    same(merchant_daily(wh, EVE, NEW_YEAR), days)
    same(business_health(wh, EVE, NEW_YEAR), store.get("dws_business_daily_health"))
    # a table without rows so far has no folder
    built = {p.name for p in (tmp_path / "store").iterdir()}
    assert set(KEYS) - built <= {"ads_platform_promotion_detail", "ads_merchant_yearly_snapshot", "data_quality_alerts"}
    assert "etl_time" in stored(spark, store.path("dws_merchant_daily")).columns
    before = {name: rows(store.get(name)) for name in built}
    build_day(wh, store, NEW_YEAR, "https://reports.example", ids)
    for name, old in before.items():
        now = rows(store.get(name))
        if name in ("dws_user_profile", "dws_product_summary", "dws_merchant_profile"):
            # the first run covers all entities, a rerun of the later day the changed ones; no row may vanish
            assert len(now) == len(old)
        assert difference(now, old) is None, name


def test_upsert_replaces_by_key_only(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "stat_date date, k string, v int"
    d1, d2 = date(2001, 1, 1), date(2001, 1, 2)
    upsert(spark.createDataFrame([(d1, "a", 1), (d1, None, 2), (d2, "a", 3)], schema), path, ["stat_date", "k"])
    upsert(spark.createDataFrame([(d1, None, 9), (d1, "b", 4)], schema), path, ["stat_date", "k"])
    got = {(r.stat_date, r.k): r.v for r in stored(spark, path).collect()}
    assert got == {(d1, "a"): 1, (d1, None): 9, (d1, "b"): 4, (d2, "a"): 3}


def test_merchant_days_add_up_to_the_platform(wh):
    day_total = merchant_daily(wh, date(2000, 1, 1), date(2000, 12, 31)).groupBy("stat_date").agg(F.sum("daily_sales").alias("s"))
    health = business_health(wh, date(2000, 1, 1), date(2000, 12, 31))
    sales = daily_sales(wh, date(2000, 1, 1), date(2000, 12, 31)).groupBy("stat_date").agg(F.sum("sales_amount").alias("t"))
    joined = health.join(day_total, "stat_date").join(sales, "stat_date")
    assert joined.count() == health.count() > 0
    assert joined.filter("daily_sales <> s or daily_sales <> t").count() == 0


def test_monthly_snapshots_equal_single_dates(wh):
    many = user_profile(wh, Cutoffs.month_starts(date(1999, 1, 1), date(1999, 4, 1)))
    for day in (date(1999, 1, 1), date(1999, 3, 1), date(1999, 4, 1)):
        same(user_profile(wh, Cutoffs.on(day)), many.filter(F.col("stat_date") == F.lit(day)))


def test_gate_stops_on_orphans(spark, wh):
    gate(warehouse_alerts(wh, NEW_YEAR))
    lost = replace(wh, orders=wh.orders.filter("l_returnflag <> 'R'"))
    with pytest.raises(QualityError, match="returns without order"):
        gate(warehouse_alerts(lost, NEW_YEAR))


def test_clean_day_stores_all_tables(spark, tmp_path):
    t = SampleTables(spark, SMALL)
    root, store = str(tmp_path / "extracts"), Store(spark, str(tmp_path / "store"))
    day = date(2024, 2, 1)
    views = {
        "users": t["users"],
        "dim_merchants": t["dim_merchants"].withColumn("contact_info", F.lit("")),
        "dim_products": t["dim_products"],
        "dim_promotions": t["dim_promotions"].withColumn("discount_rules", F.lit('{"off": 1}')),
    }
    for name in SPECS:
        raw = views[name] if name in views else t.sql(EXTRACTS[name])
        if SPECS[name].event_time in ("order_time", "operation_time"):
            # one month of the long history, so that few date folders are written
            raw = raw.filter(F.col(SPECS[name].event_time).startswith("2000-06"))
        if name == "orders":
            # some of the week's orders come back on one day, some of the returns name no reason
            back = raw.selectExpr(
                "concat('RET', order_id) AS return_id", "order_id", "trim(user_id) AS user_id", "'M1' AS merchant_id",
                "CASE WHEN order_status = 'lost' THEN '' ELSE 'other' END AS return_reason_category",
                "'Applied' AS return_status", "'2000/06/20 10:00' AS apply_time", "'1' AS return_quantity",
            )
        write_extract(back if name == "returns" else raw, root, name, day)
    clean_day(spark, root, store, day)
    stored_wh = store.warehouse()
    assert stored_wh.users.select("updated_time").first()[0] == datetime(2024, 2, 1)
    assert stored_wh.orders.count() > 0 and "event_date" in stored_wh.orders.columns
    rejected = {r[0] for r in store.get("rejected_rows").select("table_name").distinct().collect()}
    assert {"orders", "returns", "user_actions", "data_quality_alerts"} <= rejected
    # the same load again replaces itself
    counts = {name: store.get(f"dwd_{name}").count() for name in SPECS}
    rejects = store.get("rejected_rows").count()
    clean_day(spark, root, store, day)
    assert {name: store.get(f"dwd_{name}").count() for name in SPECS} == counts
    assert store.get("rejected_rows").count() == rejects
    # as the next day's load, every stored id gets a new one
    for name in SPECS:
        write_extract(read_extract(spark, root, name, day), root, name, date(2024, 2, 2))
    clean_day(spark, root, store, date(2024, 2, 2))
    users, before = store.get("dwd_users"), counts["users"]
    assert users.count() == 2 * before == users.select("user_id").distinct().count()
    assert users.filter(F.col("user_id").contains("_new1")).count() == before
    # a table without a good row keeps its rejects, and the tables after it are cleaned
    bad = read_extract(spark, root, "dim_promotions", day).withColumn("promotion_type", F.lit("giveaway"))
    later = date(2024, 2, 3)
    for name in SPECS:
        write_extract(bad if name == "dim_promotions" else read_extract(spark, root, name, day), root, name, later)
    with pytest.raises(EmptyResult, match="dim_promotions"):
        clean_day(spark, root, store, later)
    refused = store.get("rejected_rows").filter((F.col("data_date") == F.lit(later)) & (F.col("table_name") == "dim_promotions"))
    assert refused.count() == bad.count()
    assert store.get("dwd_users").filter(F.col("load_date") == F.lit(later)).count() > 0


def test_upsert_reads_only_touched_folders(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "stat_date date, k string, v int"
    days = [date(2001, 1, d) for d in range(1, 5)]
    upsert(spark.createDataFrame([(d, "a", d.day) for d in days], schema), path, ["stat_date", "k"])
    new = spark.createDataFrame([(days[1], "b", 9), (days[1], "a", 8)], schema)
    plan = untouched_rows(path, new, ["stat_date", "k"], [days[1]])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "= 2001-01-02" in plan.replace("11324", "2001-01-02")
    upsert(new, path, ["stat_date", "k"])
    got = {(r.stat_date, r.k): r.v for r in stored(spark, path).collect()}
    assert got == {(days[0], "a"): 1, (days[1], "a"): 8, (days[1], "b"): 9, (days[2], "a"): 3, (days[3], "a"): 4}


def test_backfill_equals_the_range(spark, wh, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    backfill(wh, store, EVE, NEW_YEAR)
    same(merchant_daily(wh, EVE, NEW_YEAR), store.get("dws_merchant_daily"))
    same(user_profile(wh, Cutoffs.on(EVE)), store.get("dws_user_profile").filter(F.col("stat_date") == F.lit(EVE)))
    snapshots = store.get("ads_merchant_daily_snapshot")
    assert snapshots.filter("merchant_level IS NULL").count() == 0
    assert snapshots.count() == store.get("dws_merchant_daily").count()
    # the reports that were due on New Year's day
    assert store.get("ads_user_yearly_snapshot").select("stat_year").distinct().first()[0] == 1998
    assert store.get("ads_user_monthly_snapshot").select("stat_month").distinct().first()[0] == NEW_YEAR
    assert store.get("dws_product_summary").select("stat_date").distinct().count() == 2


def test_reports_reach_the_last_fact(spark):
    models = Models(spark, SMALL)
    late = models.wh.orders.limit(1).withColumn("order_time", F.lit(datetime(2003, 5, 5)))
    models.wh = replace(models.wh, orders=models.wh.orders.unionByName(late))
    assert models.cutoffs.last == date(2003, 6, 1) and models.years[1] == 2003
    month = models.merchant_months.filter(F.col("stat_month") == F.lit(date(2003, 6, 1)))
    assert month.agg(F.sum("order_count")).first()[0] == 1
