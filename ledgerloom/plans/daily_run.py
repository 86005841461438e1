"""One day's work: clean the extracts, check, build the subject tables and the reports that are due."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.cutoffs import Cutoffs
from ledgerloom.functions.months import ReportMonths
from ledgerloom.operators.cleaning import EmptyResult
from ledgerloom.operators.key_index import KeyIndex
from ledgerloom.operators.links import LINK_KEYS, due, report_links
from ledgerloom.operators.load_manifest import LoadManifest
from ledgerloom.operators.quality import gate, warehouse_alerts
from ledgerloom.plans.business_health import business_health
from ledgerloom.plans.cleaners import clean_table
from ledgerloom.plans.daily_reports import merchant_daily_snapshot, platform_daily_snapshot
from ledgerloom.plans.daily_sales import daily_sales
from ledgerloom.plans.lifetime import Lifetime
from ledgerloom.plans.merchant_daily import merchant_daily
from ledgerloom.plans.merchant_profile import merchant_profile
from ledgerloom.plans.merchant_reports import merchant_monthly, merchant_yearly
from ledgerloom.plans.platform_reports import platform_monthly, platform_yearly, promotion_detail
from ledgerloom.plans.product_summary import product_summary, product_summary_days
from ledgerloom.plans.user_profile import user_profile
from ledgerloom.plans.user_reports import user_monthly, user_yearly
from ledgerloom.schemas import SPECS, Warehouse
from ledgerloom.session import remove, scratch_path
from ledgerloom.sources.extracts import read_extract
from ledgerloom.sources.tables import LOAD_DATE, append_clean, exists, folder_names, remove_load, replace_days, stored, upsert

# Each table's key; the first column is the partition.
KEYS = {
    "dws_daily_sales": ["stat_date", "merchant_id", "category_id"],
    "dws_merchant_daily": ["stat_date", "merchant_id"],
    "dws_merchant_profile": ["stat_date", "merchant_id"],
    "dws_product_summary": ["stat_date", "product_id"],
    "dws_user_profile": ["stat_date", "user_id"],
    "dws_business_daily_health": ["stat_date"],
    "ads_merchant_daily_snapshot": ["stat_date", "merchant_id"],
    "ads_platform_daily_snapshot": ["stat_date"],
    "ads_merchant_monthly_snapshot": ["stat_month", "merchant_id"],
    "ads_user_monthly_snapshot": ["stat_month", "user_id"],
    "ads_platform_monthly_summary": ["stat_month"],
    "ads_platform_promotion_detail": ["stat_month", "promotion_id", "user_level"],
    "ads_merchant_yearly_snapshot": ["stat_year", "merchant_id"],
    "ads_user_yearly_snapshot": ["stat_year", "user_id"],
    "ads_platform_yearly_summary": ["stat_year"],
    "report_links": LINK_KEYS,
    "data_quality_alerts": ["data_date", "problem_description"],
}
# When a stored row was computed; only kept in the files, the models do not see it.
STAMP = "etl_time"


class Store:
    """Where the tables of one warehouse live."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def get(self, name: str) -> DataFrame | None:
        table = stored(self.spark, self.path(name))
        return None if table is None else table.drop(STAMP)

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Upsert and give back the stored table, so later models read files instead of replanning."""
        upsert(df.withColumn(STAMP, F.current_timestamp()), self.path(name), KEYS[name])
        table = self.get(name)
        return df if table is None else table

    def manifest(self) -> LoadManifest:
        """What the loads have stored, and the days that wait to be built anew."""
        return LoadManifest(self.spark, self.path("load_manifest"))

    def replace_days(self, name: str, df: DataFrame, days: list[date]) -> None:
        """Put rows in place of all stored rows of some days."""
        replace_days(df.withColumn(STAMP, F.current_timestamp()), self.path(name), KEYS[name][0], days)

    def built(self, name: str) -> list[date]:
        """Days a table holds, from its folder names."""
        return [date.fromisoformat(d) for d in folder_names(self.spark, self.path(name), KEYS[name][0])]

    def warehouse(self) -> Warehouse:
        """The cleaned tables as stored."""
        return Warehouse(
            users=self.get("dwd_users"),
            merchants=self.get("dwd_dim_merchants"),
            products=self.get("dwd_dim_products"),
            promotions=self.get("dwd_dim_promotions"),
            orders=self.get("dwd_orders"),
            returns=self.get("dwd_returns"),
            actions=self.get("dwd_user_actions"),
            operations=self.get("dwd_merchant_operations"),
        )


def clean_load(spark: SparkSession, extracts: str, store: Store, name: str, day: date) -> int:
    """Clean one table's extract of a day and store it as that day's load; gives back the number of good rows.

    Rejected rows are stored before good ones. A repeated load replaces its earlier try, also by nothing; only keys of other loads count
    as stored. They are looked up in an index of ids, which the load then extends.
    """
    spec = SPECS[name]
    references = {ref.table: store.get(f"dwd_{ref.table}") for ref in spec.references}
    if missing := [table for table, rows in references.items() if rows is None]:
        raise EmptyResult(f"{name} refers to {missing}, of which nothing is stored")
    index = KeyIndex(spark, store.path(f"key_index/{name}")) if spec.key else None
    earlier = store.get(f"dwd_{name}") if index and not index.exists() else None
    if earlier is not None:
        index.build(earlier, spec.key)
    resolve = (lambda rows: index.resolve(rows, spec.key, but=day)) if index else None
    result = clean_table(read_extract(spark, extracts, name, day), spec, references, resolve=resolve)
    scratch = scratch_path(spark, f"clean-{name}")
    result.rows.write.parquet(scratch)
    rows = spark.read.schema(result.rows.schema).parquet(scratch)
    rejected = result.rejected.withColumn("data_date", F.lit(day)).withColumn("rejected_from", F.lit(name))
    remove(spark, f"{store.path('rejected_rows')}/data_date={day}/rejected_from={name}")
    rejected.write.mode("append").partitionBy("data_date", "rejected_from").parquet(store.path("rejected_rows"))
    # days that a late or repeated load changes are noted before its rows are replaced (plans/late_loads.py)
    announced = None
    if spec.event_time:
        typed = rows.select(*[F.col(c).cast(kind).alias(c) for c, kind in spec.types.items()])
        announced = store.manifest().announce(name, day, typed, F.to_date(spec.event_time))
    remove_load(spark, store.path(f"dwd_{name}"), spec, day)
    good = rows.count()
    if index:
        # before the rows: ids of a load that stops in between are at worst used for nothing until it is repeated
        index.add(rows, spec.key, day)
    if good:
        append_clean(rows, store.path(f"dwd_{name}"), spec, datetime.combine(day, datetime.min.time()), day)
    if announced:
        store.manifest().settle(name, day, announced)
    remove(spark, scratch)
    return good


def clean_day(spark: SparkSession, extracts: str, store: Store, day: date) -> None:
    """Clean all nine extracts of a day, parents before children.

    Every table is done before an empty one stops the run, so nothing is lost.
    """
    empty = [name for name in SPECS if not clean_load(spark, extracts, store, name, day)]
    if empty:
        raise EmptyResult(f"no rows left for {', '.join(empty)}")


def build_day(wh: Warehouse, store: Store, day: date, link_base: str = "", public_ids: dict | None = None) -> None:
    """Subject tables, then reports. A rerun of a day replaces its rows.

    Where the facts tell their load (tables stored by ``clean_load``), lifetime counters are carried: the day's load is added
    to the totals of the day before, and a rerun after a repeated load puts the totals right from that day on.

    Monthly reports are built on day 1, yearly ones on January 1, for the period that just ended. The
    platform month reads the merchant months, and the merchant profile the day table, so those come first.
    """
    remove(store.spark, f"{store.path('data_quality_alerts')}/data_date={day}")
    alerts = store.put("data_quality_alerts", warehouse_alerts(wh, day))
    gate(alerts.filter(F.col("data_date") == F.lit(day)))
    first_run = not exists(store.spark, store.path("dws_user_profile"))
    stored_data = Cutoffs.on(day, open_end=True)

    store.put("dws_daily_sales", daily_sales(wh, day, day))
    days = store.put("dws_merchant_daily", merchant_daily(wh, day, history=store.get("dws_merchant_daily")))
    merchants = products = users = tastes = None
    if LOAD_DATE in wh.orders.columns and LOAD_DATE in wh.returns.columns:
        lifetime = Lifetime(store.spark, store.path("lifetime"))
        lifetime.advance(wh, days, day)
        tables = (lifetime.merchants, lifetime.products, lifetime.users, lifetime.tastes)
        merchants, products, users, tastes = (t.totals(day) for t in tables)
    changed = {"changed_only": not first_run}
    profiles = store.put("dws_merchant_profile", merchant_profile(wh, days, stored_data, carried=merchants, **changed))
    store.put("dws_product_summary", product_summary(wh, day, carried=products, **changed))
    store.put("dws_user_profile", user_profile(wh, stored_data, carried=users, tastes=tastes, **changed))
    health = store.put(
        "dws_business_daily_health",
        business_health(wh, day, day, history=store.get("dws_business_daily_health")),
    )
    store.put("ads_merchant_daily_snapshot", merchant_daily_snapshot(days, profiles, day))
    store.put("ads_platform_daily_snapshot", platform_daily_snapshot(health, day))
    build_due_reports(wh, store, day)
    if public_ids:
        store.put("report_links", report_links(wh.users, wh.merchants, day, link_base, public_ids))


def build_due_reports(wh: Warehouse, store: Store, day: date) -> None:
    """The monthly and yearly reports that are due on a day, from the stored subject tables and daily reports."""
    if not due("monthly", day):
        return
    months, users = ReportMonths.one(day), store.get("dws_user_profile")
    name = "ads_merchant_monthly_snapshot"
    snapshots = store.get("ads_merchant_daily_snapshot")
    merchant_months = store.put(name, merchant_monthly(wh, snapshots, months, store.get(name)))
    name = "ads_user_monthly_snapshot"
    user_months = store.put(name, user_monthly(wh, users, months, store.get(name)))
    store.put("ads_platform_promotion_detail", promotion_detail(wh, users, months))
    platform = store.get("ads_platform_daily_snapshot")
    name = "ads_platform_monthly_summary"
    platform_months = store.put(name, platform_monthly(wh, platform, merchant_months, users, months))
    if not due("yearly", day):
        return
    year = day.year - 1
    name = "ads_merchant_yearly_snapshot"
    merchant_years = store.put(name, merchant_yearly(wh, merchant_months, year, history=store.get(name)))
    name = "ads_user_yearly_snapshot"
    store.put(name, user_yearly(wh, user_months, year, history=store.get(name)))
    store.put("ads_platform_yearly_summary", platform_yearly(wh, platform_months, merchant_years, year))


def backfill(wh: Warehouse, store: Store, first: date, last: date, link_base: str = "", public_ids: dict | None = None) -> None:
    """Rebuild a range of days, with the reports that were due in it. The day tables and the product table are computed in one
    pass over the range; the profiles, which restate all entities per date, go date by date. All count what had happened by their
    date, as a run on that day would have."""
    store.put("dws_daily_sales", daily_sales(wh, first, last))
    days = store.put("dws_merchant_daily", merchant_daily(wh, first, last, store.get("dws_merchant_daily")))
    health = store.put(
        "dws_business_daily_health",
        business_health(wh, first, last, history=store.get("dws_business_daily_health")),
    )
    store.put("ads_platform_daily_snapshot", platform_daily_snapshot(health))
    store.put("dws_product_summary", product_summary_days(wh, first, last))
    day = first
    while day <= last:
        at = Cutoffs.on(day)
        profiles = store.put("dws_merchant_profile", merchant_profile(wh, days, at))
        store.put("dws_user_profile", user_profile(wh, at))
        store.put("ads_merchant_daily_snapshot", merchant_daily_snapshot(days, profiles, day))
        build_due_reports(wh, store, day)
        if public_ids:
            store.put("report_links", report_links(wh.users, wh.merchants, day, link_base, public_ids))
        day += timedelta(days=1)


__all__ = ["EmptyResult", "Store", "backfill", "build_day", "clean_day", "clean_load"]
