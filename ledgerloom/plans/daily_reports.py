"""Daily report tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.fold import gathered
from ledgerloom.session import staged_alone

MERCHANT_COLUMNS = [
    "stat_date",
    "merchant_id",
    "merchant_name",
    "merchant_level",
    "daily_sales",
    "order_count",
    "customer_count",
    "refund_count",
    "sales_mom",
    "sales_yoy",
    "order_count_mom",
    "refund_rate",
    "zero_sales_flag",
    "abnormal_sales_flag",
]
PLATFORM_COLUMNS = [
    "stat_date",
    "daily_sales",
    "daily_orders",
    "active_users",
    "new_users",
    "conversion_rate",
    "refund_count",
    "refund_rate",
    "health_score",
    "sales_drop_warning",
    "conversion_drop_warning",
    "refund_spike_warning",
]


def merchant_daily_snapshot(daily: DataFrame, profile: DataFrame, day: date | None = None, lazy: bool = False) -> DataFrame:
    """The merchant day table with name and level of the same date's profile; all dates if no day is given.

    Of all dates, a merchant's names are one row with a map by date, dealt by the merchant as the days are: the days of all
    merchants, far more rows than there are facts, are not shuffled and sorted again by date. The names are staged, so the call
    runs a job. ``lazy`` joins them by date instead, for reports that read the counters alone: Spark leaves the join out there.
    """
    c = F.col
    if day is not None:
        daily, profile = (df.filter(c("stat_date") == F.lit(day)) for df in (daily, profile))
    if lazy or day is not None:
        named = profile.select("stat_date", "merchant_id", "merchant_name", "merchant_level")
        return daily.join(named, ["stat_date", "merchant_id"], "left").select(*MERCHANT_COLUMNS)
    known = profile.filter(c("stat_date").isNotNull() & c("merchant_id").isNotNull())
    known = staged_alone(known.select("stat_date", "merchant_id", "merchant_name", "merchant_level"), "merchant-names")
    # a date's names are a list, as each of several rows would join
    on_date = F.collect_list(F.struct("merchant_name", "merchant_level")).alias("_named")
    by_date = F.map_from_entries(F.collect_list(F.struct("stat_date", "_named"))).alias("_by_date")
    dates = gathered(known, "merchant_id").groupBy("merchant_id", "stat_date").agg(on_date).groupBy("merchant_id").agg(by_date)
    found = daily.join(dates, "merchant_id", "left").withColumn("_named", F.try_element_at("_by_date", c("stat_date")))
    return found.select(*daily.columns, F.inline_outer("_named")).select(*MERCHANT_COLUMNS)


def platform_daily_snapshot(health: DataFrame, day: date | None = None) -> DataFrame:
    """The health table without the average order amount."""
    if day is not None:
        health = health.filter(F.col("stat_date") == F.lit(day))
    return health.select(*PLATFORM_COLUMNS)
