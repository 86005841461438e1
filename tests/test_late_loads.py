"""Late and repeated loads: which days they change, and that only those are rebuilt."""

from dataclasses import replace
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from ledgerloom.functions.columns import EVENT_DATE
from ledgerloom.operators.load_manifest import LoadManifest
from ledgerloom.plans.daily_run import Store, backfill, clean_load
from ledgerloom.plans.daily_sales import daily_sales
from ledgerloom.plans.late_loads import days_of_returns, reached, refresh, refresh_days, spans
from ledgerloom.plans.merchant_daily import merchant_daily
from ledgerloom.sources.extracts import write_extract
from ledgerloom.sources.samples import SampleTables, sample_warehouse
from ledgerloom.sources.tables import folder_names, replace_days, stored
from verification.compare import difference
from verification.dirty import EXTRACTS

D = [date(2001, 1, 1) + timedelta(days=n) for n in range(60)]
SCHEMA = "id string, at timestamp, amount int"


@pytest.fixture(scope="module")
def wh(spark):
    return sample_warehouse(spark, SMALL)


def at(day):
    return datetime(day.year, day.month, day.day, 9)


def load(spark, manifest, rows, settle=True, name="orders", on=D[5]):
    announced = manifest.announce(name, on, spark.createDataFrame(rows, SCHEMA), F.to_date("at"))
    if settle:
        manifest.settle(name, on, announced)
    pending = manifest.pending()
    manifest.done(pending)
    return pending.days


def test_reached_and_spans():
    built = D[10:50]
    assert reached([D[2], D[45]], 10, built) == [*D[10:13], *D[45:50]]
    assert reached([], 30, built) == [] and reached([D[11]], 0, built) == [D[11]]
    assert spans([D[1], D[2], D[3], D[7], D[9], D[10]]) == [(D[1], D[3]), (D[7], D[7]), (D[9], D[10])] and spans([]) == []


def test_a_load_names_the_days_it_changes(spark, tmp_path):
    manifest = LoadManifest(spark, str(tmp_path / "m"))
    assert manifest.pending().days == {}
    rows = [("a", at(D[3]), 1), ("b", at(D[4]), 2), ("b", at(D[4]), 2), ("c", None, 3), (None, at(D[5]), None)]
    assert load(spark, manifest, rows) == {"orders": [D[3], D[4], D[5]]}
    # equal rows in another order change nothing; another load or table of the same days stands for itself
    assert load(spark, manifest, rows[::-1]) == {}
    assert load(spark, manifest, rows[:1], on=D[6]) == {"orders": [D[3]]}
    assert load(spark, manifest, rows[:1], name="returns") == {"returns": [D[3]]}
    # one row of two equal ones less, one cell NULL, a day that vanishes, a new one
    assert load(spark, manifest, [*rows[:2], *rows[3:]]) == {"orders": [D[4]]}
    assert load(spark, manifest, [("a", at(D[3]), None), rows[1], rows[4]]) == {"orders": [D[3]]}
    assert load(spark, manifest, [rows[1], rows[4], ("z", at(D[8]), 1)]) == {"orders": [D[3], D[8]]}
    assert load(spark, manifest, []) == {"orders": [D[4], D[5], D[8]]}
    assert load(spark, manifest, []) == {}


def test_a_load_that_stopped_names_its_days_again(spark, tmp_path):
    manifest = LoadManifest(spark, str(tmp_path / "m"))
    first, second = [("a", at(D[3]), 1)], [("a", at(D[4]), 1)]
    load(spark, manifest, first)
    assert load(spark, manifest, second, settle=False) == {"orders": [D[3], D[4]]}
    # whatever it left behind is not known: even the rows of before are named, and the days of the try
    assert load(spark, manifest, first) == {"orders": [D[3], D[4]]}
    assert load(spark, manifest, first) == {}
    # entries noted while others are worked on stay
    announced = manifest.announce("orders", D[9], spark.createDataFrame(first, SCHEMA), F.to_date("at"))
    pending = manifest.pending()
    manifest.settle("orders", D[9], announced)
    load_two = manifest.announce("orders", D[10], spark.createDataFrame(second, SCHEMA), F.to_date("at"))
    manifest.done(pending)
    assert manifest.pending().days == {"orders": [D[4]]}
    manifest.settle("orders", D[10], load_two)


def test_replace_days(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "stat_date date, k string, v int"
    replace_days(spark.createDataFrame([(d, "a", d.day) for d in D[:4]], schema), path, "stat_date", D[:4])
    table = stored(spark, path).select("stat_date", "k", "v")
    # reads what it replaces; one day keeps one row, one loses its folder
    replace_days(table.filter(F.col("stat_date") == F.lit(D[1])).withColumn("v", F.col("v") * 10), path, "stat_date", [D[1], D[2]])
    assert folder_names(spark, path, "stat_date") == [str(D[0]), str(D[1]), str(D[3])]
    assert {(r.stat_date, r.v) for r in stored(spark, path).collect()} == {(D[0], 1), (D[1], 20), (D[3], 4)}


def test_a_day_without_rows_is_built_too(spark, wh, tmp_path):
    store, day = Store(spark, str(tmp_path / "store")), date(2000, 6, 15)
    first, last = day - timedelta(days=2), day + timedelta(days=2)
    without = F.to_date("order_time") != F.lit(day)
    gone = F.to_date("apply_time") != F.lit(day)
    store.put("dws_daily_sales", daily_sales(replace(wh, orders=wh.orders.filter(without), returns=wh.returns.filter(gone)), first, last))
    sold = wh.orders.limit(1).withColumn("order_time", F.lit(at(day)).cast("timestamp"))
    whole = replace(wh, orders=wh.orders.filter(without).unionByName(sold), returns=wh.returns.filter(gone))
    store.manifest().announce("orders", last, sold, F.to_date("order_time"))
    assert day not in store.built("dws_daily_sales")
    refresh_days(whole, store, store.manifest().pending(), ("dws_daily_sales",))
    theirs = daily_sales(whole, day, day)
    mine = store.get("dws_daily_sales").filter(F.col("stat_date") == F.lit(day)).select(*theirs.columns).toPandas()
    assert len(mine) == 1 and difference(mine, theirs.toPandas()) is None


def files(root: str) -> dict[str, int]:
    return {str(p): p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}


def test_other_folders_are_neither_read_nor_written(spark, wh, tmp_path):
    """A fact of one day is added; facts of days beyond its reach are made unreadable, so reading one would fail."""
    store, day = Store(spark, str(tmp_path / "store")), date(2000, 6, 15)
    first, last = day - timedelta(days=45), day + timedelta(days=40)
    recent = (F.col(EVENT_DATE) >= F.lit(first)) & (F.col(EVENT_DATE) <= F.lit(last))
    for name, time in (("orders", "order_time"), ("returns", "apply_time")):
        facts = getattr(wh, name).withColumn(EVENT_DATE, F.to_date(time)).filter(recent)
        facts.hint("rebalance", EVENT_DATE).write.partitionBy(EVENT_DATE).parquet(store.path(name))
    # stated schemas, as finding one out would open some file
    schemas = {n: spark.read.parquet(store.path(n)).schema for n in ("orders", "returns")}
    read = lambda: replace(wh, **{n: spark.read.schema(schema).parquet(store.path(n)) for n, schema in schemas.items()})
    store.put("dws_merchant_daily", merchant_daily(read(), first, last))
    before = files(store.path("dws_merchant_daily"))
    late = wh.orders.limit(1).withColumn("order_time", F.lit(at(day)).cast("timestamp")).withColumn("order_id", F.lit("late"))
    store.manifest().announce("orders", last, late, F.to_date("order_time"))
    late.withColumn(EVENT_DATE, F.to_date("order_time")).write.mode("append").partitionBy(EVENT_DATE).parquet(store.path("orders"))
    whole = merchant_daily(read(), first, last).toPandas()
    for name in ("orders", "returns"):
        for path in Path(store.path(name)).rglob("*.parquet"):
            event = date.fromisoformat(path.parent.name.split("=")[1])
            if not day <= event <= day + timedelta(days=30):
                path.write_bytes(b"no parquet")
                path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    rebuilt = refresh_days(read(), store, store.manifest().pending(), ("dws_merchant_daily",))
    assert rebuilt == {"dws_merchant_daily": [day + timedelta(days=n) for n in range(31)]}
    after = files(store.path("dws_merchant_daily"))
    kept = {p for p in before if p in after and before[p] == after[p]}
    assert {Path(p).parent.name.split("=")[1] for p in kept} == {str(first + timedelta(days=n)) for n in range(86) if not 45 <= n <= 75}
    assert difference(store.get("dws_merchant_daily").select(*whole.columns).toPandas(), whole) is None
    with pytest.raises(Exception, match="(?i)parquet"):
        merchant_daily(read(), first, last).toPandas()


def test_returns_of_changed_orders(spark, wh):
    returned = wh.returns.join(wh.orders.select("order_id", "order_time"), "order_id")
    ordered, back = returned.select(F.to_date("order_time"), F.to_date("apply_time")).first()
    assert ordered != back and back in days_of_returns(wh, [ordered]) and days_of_returns(wh, []) == []


def test_refresh_equals_a_rebuild(spark, wh, tmp_path):
    """All tables of two days and the reports due in them, after a load of wrong orders is repeated and a return comes late."""
    eve, new_year, day = date(1998, 12, 31), date(1999, 1, 1), date(1998, 12, 20)
    store, fresh = Store(spark, str(tmp_path / "store")), Store(spark, str(tmp_path / "fresh"))
    of_day = F.to_date("order_time") == F.lit(day)
    moved = wh.orders.filter(of_day).withColumn("order_time", F.lit(at(eve)).cast("timestamp"))
    moved = moved.withColumn("order_amount", (F.col("order_amount") * 3).cast("decimal(10,2)"))
    late = wh.returns.orderBy("return_id").limit(1).withColumn("apply_time", F.lit(at(eve)).cast("timestamp")).withColumn("return_id", F.lit("late"))
    wrong = replace(wh, orders=wh.orders.filter(~of_day).unionByName(moved))
    wh = replace(wh, returns=wh.returns.unionByName(late))
    assert moved.count() and late.count()
    manifest = store.manifest()
    manifest.settle("orders", eve, manifest.announce("orders", eve, moved, F.to_date("order_time")))
    backfill(wrong, store, eve, new_year)
    manifest.done(manifest.pending())
    manifest.settle("orders", eve, manifest.announce("orders", eve, wh.orders.filter(of_day), F.to_date("order_time")))
    manifest.settle("returns", new_year, manifest.announce("returns", new_year, late, F.to_date("apply_time")))
    assert manifest.pending().days == {"orders": [day, eve], "returns": [eve]}
    rebuilt = refresh(wh, store)
    assert rebuilt["dws_daily_sales"] == [eve] and rebuilt["dws_merchant_daily"] == [eve, new_year]
    assert manifest.pending().days == {} and refresh(wh, store)["dws_user_profile"] == []
    backfill(wh, fresh, eve, new_year)
    names = [p.name for p in (tmp_path / "fresh").iterdir()]
    assert len(names) >= 12
    for name in names:
        theirs = fresh.get(name)
        assert difference(store.get(name).select(*theirs.columns).toPandas(), theirs.toPandas()) is None, name
    assert difference(store.get("dws_daily_sales").toPandas(), daily_sales(wrong, eve, new_year).toPandas()) is not None


def test_cleaned_loads_are_noted(spark, tmp_path):
    t, day = SampleTables(spark, SMALL), date(2024, 2, 1)
    root, store = str(tmp_path / "extracts"), Store(spark, str(tmp_path / "store"))
    views = {"users": t["users"], "dim_merchants": t["dim_merchants"].withColumn("contact_info", F.lit("")), "dim_products": t["dim_products"]}
    for name, raw in views.items():
        write_extract(raw, root, name, day)
        assert clean_load(spark, root, store, name, day)
    raw = t.sql(EXTRACTS["user_actions"]).limit(50)
    write_extract(raw, root, "user_actions", day)
    good = clean_load(spark, root, store, "user_actions", day)
    held = {r[0] for r in store.get("dwd_user_actions").select(EVENT_DATE).distinct().collect()}
    pending = store.manifest().pending()
    assert good and pending.days == {"user_actions": sorted(held)}
    store.manifest().done(pending)
    # the same extract again changes no day
    assert clean_load(spark, root, store, "user_actions", day) == good
    assert store.manifest().pending().days == {}
