"""Day tables after a late load and a repeated one, brought up to date by their reached days alone, as registered queries.

The tables are built while one load is stored with wrong rows and another is missing; both are then stored and noted, and the twins are
those of the tables built from all facts at once.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import EVENT_DATE
from ledgerloom.plans.business_health import business_health
from ledgerloom.plans.daily_run import Store
from ledgerloom.plans.daily_sales import daily_sales
from ledgerloom.plans.late_loads import refresh_days
from ledgerloom.plans.merchant_daily import merchant_daily
from ledgerloom.schemas import Warehouse
from ledgerloom.session import remove, scratch_path, staged
from ledgerloom.sources.samples import sample_warehouse
from ledgerloom.sources.tables import LOAD_DATE, read_table
from verification import oracles as o
from verification.shape import plain

DAY = date.fromisoformat(o.ONE_DAY)
FIRST, LAST = DAY - timedelta(days=60), DAY + timedelta(days=10)
#: Days that are compared; what they look back on lies after FIRST, as the stored tables begin there.
SHOWN = DAY - timedelta(days=25)
#: The load that is first stored wrong, and the one that comes late with facts of three days far apart.
REPEATED, LATE = DAY - timedelta(days=20), LAST + timedelta(days=1)
LATE_DAYS = [DAY - timedelta(days=24), DAY - timedelta(days=2), DAY + timedelta(days=3)]
TIMES = {"orders": ("order_id", "order_time"), "returns": ("return_id", "apply_time"), "user_actions": ("action_id", "action_time")}


def loads(df: DataFrame, key: str, time: str) -> DataFrame:
    """Facts with their event date and load: a fifth of the late days' facts come late, a quarter of each other day's two days on."""
    happened, ticket = F.to_date(time), F.crc32(F.col(key).cast("string").cast("binary"))
    late = happened.isin(LATE_DAYS) & (ticket % 5 == 0)
    usual = F.date_add(happened, F.when(ticket % 4 == 0, 2).otherwise(0))
    return df.withColumns({EVENT_DATE: happened, LOAD_DATE: F.when(late, F.lit(LATE)).otherwise(usual)})


def spoiled(df: DataFrame, name: str) -> DataFrame:
    """The rows of the repeated load as they come first: some missing, orders twice as dear and a week too late."""
    rows = df.filter(F.crc32(F.col(TIMES[name][0]).cast("string").cast("binary")) % 3 > 0)
    if name != "orders":
        return rows
    later = rows.withColumn("order_time", F.col("order_time") + F.expr("INTERVAL 7 DAYS"))
    return later.withColumns({"order_amount": (F.col("order_amount") * 2).cast("decimal(10,2)"), EVENT_DATE: F.to_date("order_time")})


def store_load(store: Store, name: str, rows: DataFrame, load: date) -> None:
    """As ``clean_load`` stores a day's load, without the row rules."""
    manifest, path = store.manifest(), store.path(name)
    announced = manifest.announce(name, load, rows.drop(EVENT_DATE, LOAD_DATE), F.to_date(TIMES[name][1]))
    remove(store.spark, f"{path}/{EVENT_DATE}=*/{LOAD_DATE}={load}")
    rows.withColumn(LOAD_DATE, F.lit(load)).write.mode("append").partitionBy(EVENT_DATE, LOAD_DATE).parquet(path)
    manifest.settle(name, load, announced)


def stored_facts(wh: Warehouse, store: Store) -> Warehouse:
    names = {"orders": "orders", "returns": "returns", "actions": "user_actions"}
    return replace(wh, **{field: read_table(store.spark, store.path(name)) for field, name in names.items()})


def refreshed(spark, sf_dir: str, table: str) -> DataFrame:
    """A day table, built on wrong and missing loads and brought up to date after they are put right."""
    wh, store = sample_warehouse(spark, sf_dir), Store(spark, scratch_path(spark, "late"))
    # staged, as four loads are cut out of each
    facts = {name: staged(loads(df, *TIMES[name]), f"loads-{name}") for name, df in (("orders", wh.orders), ("returns", wh.returns), ("user_actions", wh.actions))}
    recent = (F.col(EVENT_DATE) >= F.lit(FIRST)) & (F.col(EVENT_DATE) <= F.lit(LAST))
    for name, df in facts.items():
        # facts that no shown day looks at lie in one folder; returns ask for their orders of any day
        folder = F.when(recent, F.col(EVENT_DATE)).otherwise(F.lit(date(1990, 1, 1)))
        kept = df.filter(~F.col(LOAD_DATE).isin(REPEATED, LATE) | ~recent).withColumns({EVENT_DATE: folder, LOAD_DATE: F.lit(FIRST)})
        kept.hint("rebalance", EVENT_DATE).write.partitionBy(EVENT_DATE, LOAD_DATE).parquet(store.path(name))
        store_load(store, name, spoiled(df.filter(F.col(LOAD_DATE) == F.lit(REPEATED)), name), REPEATED)
    first = stored_facts(wh, store)
    builders = {"dws_daily_sales": daily_sales, "dws_merchant_daily": merchant_daily, "dws_business_daily_health": business_health}
    store.put(table, builders[table](first, FIRST, LAST))
    store.manifest().done(store.manifest().pending())
    for name, df in facts.items():
        for load in (REPEATED, LATE):
            store_load(store, name, df.filter(recent & (F.col(LOAD_DATE) == F.lit(load))), load)
    refresh_days(stored_facts(wh, store), store, store.manifest().pending(), (table,))
    return store.get(table).filter((F.col("stat_date") >= F.lit(SHOWN)) & (F.col("stat_date") <= F.lit(LAST)))


def of_days(sql: str) -> str:
    return f"SELECT * FROM ({sql}) whole WHERE CAST(stat_date AS DATE) BETWEEN DATE '{SHOWN}' AND DATE '{LAST}'"


CHECKED = {
    "late_load_daily_sales": ("dws_daily_sales", of_days(o.daily_sales_sql())),
    "late_load_merchant_daily": ("dws_merchant_daily", of_days(o.merchant_daily_sql())),
    "late_load_business_health": ("dws_business_daily_health", of_days(o.health_sql())),
}


def _bind(table):
    return lambda spark, sf_dir: plain(refreshed(spark, sf_dir, table))


QUERIES = {name: _bind(table) for name, (table, _) in CHECKED.items()}
ORACLES = {name: sql for name, (_, sql) in CHECKED.items()}
