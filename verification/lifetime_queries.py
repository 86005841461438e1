"""Lifetime totals carried over ten days of loads, and a week of product summaries in one pass, as registered queries."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.cutoffs import Cutoffs
from ledgerloom.plans.lifetime import Lifetime
from ledgerloom.plans.merchant_profile import merchant_profile
from ledgerloom.plans.product_summary import product_summary, product_summary_days
from ledgerloom.plans.user_profile import user_profile
from ledgerloom.schemas import Warehouse
from ledgerloom.session import scratch_path, staged
from ledgerloom.sources.samples import sample_warehouse
from ledgerloom.sources.tables import LOAD_DATE
from verification import oracles as o
from verification.model_queries import Models
from verification.shape import plain

DAY = date.fromisoformat(o.ONE_DAY)
DAYS = [DAY - timedelta(days=n) for n in range(10, -1, -1)]
#: This load is first taken in with wrong rows, and put right two loads later.
WRONG = DAYS[4]
CLOSED = Cutoffs.on(DAY)


def stored_loads(wh: Warehouse, root: str) -> Warehouse:
    """Orders and returns in folders by load: most on their day, some up to two days late, all earlier ones in the first load."""

    def write(df: DataFrame, name: str, key: str, time: str) -> DataFrame:
        happened = F.to_date(time)
        late = F.least(F.date_add(happened, (F.crc32(F.col(key).cast("binary")) % 3).cast("int")), F.lit(DAY))
        load = F.when(happened > F.lit(DAY), F.lit(DAY + timedelta(days=30))).otherwise(F.greatest(late, F.lit(DAYS[0])))
        df.withColumn(LOAD_DATE, load).write.partitionBy(LOAD_DATE).parquet(f"{root}/{name}")
        return df.sparkSession.read.parquet(f"{root}/{name}")

    return replace(wh, orders=write(wh.orders, "orders", "order_id", "order_time"), returns=write(wh.returns, "returns", "return_id", "apply_time"))


def spoiled(wh: Warehouse) -> Warehouse:
    """The warehouse with one load in which orders are doubled, dear and from the future, and returns are missing."""
    of_load = F.col(LOAD_DATE) == F.lit(WRONG)
    doubled = wh.orders.filter(of_load).withColumn("order_time", F.col("order_time") + F.expr("INTERVAL 400 DAYS"))
    doubled = doubled.withColumn("order_amount", (F.col("order_amount") * 2).cast("decimal(10,2)"))
    return replace(wh, orders=wh.orders.unionByName(doubled), returns=wh.returns.filter(~of_load))


def carried(wh: Warehouse, daily: DataFrame, only: tuple[str, ...]) -> Lifetime:
    """Totals after the last day: ten daily loads on top of one with all history, one of them repeated."""
    spark = wh.orders.sparkSession
    lifetime, bad = Lifetime(spark, scratch_path(spark, "lifetime")), spoiled(wh)
    for n, day in enumerate(DAYS):
        lifetime.advance(bad if day == WRONG else wh, daily, day, only)
        if n == DAYS.index(WRONG) + 2:
            lifetime.advance(wh, daily, WRONG, only)
    return lifetime


def _users(spark, sf_dir):
    wh = stored_loads(sample_warehouse(spark, sf_dir), scratch_path(spark, "loads"))
    totals = carried(wh, spark.createDataFrame([], "stat_date date"), ("users", "tastes"))
    return user_profile(wh, CLOSED, carried=totals.users.totals(DAY), tastes=totals.tastes.totals(DAY))


def _products(spark, sf_dir):
    wh = stored_loads(sample_warehouse(spark, sf_dir), scratch_path(spark, "loads"))
    totals = carried(wh, spark.createDataFrame([], "stat_date date"), ("products",))
    return product_summary(wh, DAY, carried=totals.products.totals(DAY))


def _merchants(spark, sf_dir):
    models = Models(spark, sf_dir)
    days = models.days.select("merchant_id", "stat_date", "daily_sales", "order_count").filter(F.col("stat_date") <= F.lit(DAY))
    days = staged(days, "merchant-days")
    wh = stored_loads(models.wh, scratch_path(spark, "loads"))
    totals = carried(wh, days, ("merchants",))
    return merchant_profile(wh, days, CLOSED, carried=totals.merchants.totals(DAY))


def _week(spark, sf_dir):
    return product_summary_days(sample_warehouse(spark, sf_dir), DAY - timedelta(days=6), DAY)


WEEK_DATES = f"SELECT CAST(unnest(generate_series(DATE '{o.ONE_DAY}' - 6, DATE '{o.ONE_DAY}', INTERVAL 1 DAY)) AS DATE) AS as_of"

CHECKED = {
    "carried_user_profile": (_users, o.user_profile_sql(o.DAY_DATE, True)),
    "carried_product_summary": (_products, o.product_summary_sql(bounded=True)),
    "carried_merchant_profile": (_merchants, o.merchant_profile_sql(o.DAY_DATE, True)),
    "dws_product_summary_week": (_week, o.product_summary_sql(dates=WEEK_DATES, bounded=True)),
}


def _bind(build):
    return lambda spark, sf_dir: plain(build(spark, sf_dir))


QUERIES = {name: _bind(build) for name, (build, _) in CHECKED.items()}
ORACLES = {name: sql for name, (_, sql) in CHECKED.items()}
