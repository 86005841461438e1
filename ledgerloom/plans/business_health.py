"""Platform health per day: totals, conversion, a score against the trailing month, and warnings."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import (
    between_days,
    capped_share,
    exact_mean,
    is_true,
    ratio,
    ratio_or_zero,
    zero_if_null,
)
from ledgerloom.schemas import Warehouse

# Actions that make a user active.
ACTIVE_ACTIONS = ["register", "login", "browse", "favorite", "add_cart", "purchase", "search"]
COLUMNS = [
    "stat_date",
    "daily_sales",
    "daily_orders",
    "active_users",
    "new_users",
    "conversion_rate",
    "refund_count",
    "refund_rate",
    "avg_order_amount",
    "health_score",
    "health_score_raw",
    "sales_drop_warning",
    "conversion_drop_warning",
    "refund_spike_warning",
]
_MEASURES = {
    "daily_sales": "decimal(24,2)",
    "active_users": "bigint",
    "new_users": "bigint",
    # as many digits as a double has, so that the mean is that of the stored rates whatever the order of additions
    "conversion_rate": "decimal(38,18)",
    "refund_rate": "decimal(38,18)",
}


def platform_day_counters(wh: Warehouse, start: date | None, end: date | None) -> DataFrame:
    """One row per day with orders. Each total goes through one row per (day, user), so a busy day or
    a busy user is spread over tasks before the day is folded."""
    ordered = (
        between_days(wh.orders, "order_time", start, end)
        .groupBy(F.to_date("order_time").alias("stat_date"), "user_id")
        .agg(F.sum("order_amount").alias("amount"), F.count("order_id").alias("orders"))
        .groupBy("stat_date")
        .agg(
            F.sum("amount").cast("decimal(24,2)").alias("daily_sales"),
            F.sum("orders").alias("daily_orders"),
            F.count("user_id").alias("customers"),
        )
    )
    refunded = (
        between_days(wh.returns, "apply_time", start, end)
        .groupBy(F.to_date("apply_time").alias("stat_date"))
        .agg(F.count("return_id").alias("refund_count"))
    )
    seen = (
        between_days(wh.actions, "action_time", start, end)
        .filter(F.col("action_type").isin(ACTIVE_ACTIONS))
        .groupBy(F.to_date("action_time").alias("stat_date"), "user_id")
        .agg(F.max(F.when(F.col("action_type") == "register", F.col("user_id"))).alias("registered"))
        .groupBy("stat_date")
        .agg(
            F.count("user_id").alias("active_users"),
            # no registration on the day leaves the counter empty, as an absent row would
            F.nullif(F.count("registered"), F.lit(0)).alias("new_users"),
        )
    )
    return (
        ordered.join(refunded, "stat_date", "left")
        .join(seen, "stat_date", "left")
        .select(
            "stat_date",
            "daily_sales",
            "daily_orders",
            "active_users",
            "new_users",
            ratio_or_zero(F.col("customers"), F.col("active_users")).alias("conversion_rate"),
            zero_if_null(F.col("refund_count")).alias("refund_count"),
            ratio_or_zero(zero_if_null(F.col("refund_count")), F.col("daily_orders")).alias("refund_rate"),
            ratio(F.col("daily_sales"), F.col("daily_orders")).alias("avg_order_amount"),
        )
    )


def business_health(
    wh: Warehouse, start: date | None = None, end: date | None = None, history: DataFrame | None = None
) -> DataFrame:
    """Daily platform health; a range supplies the history of its own later days."""
    counters = platform_day_counters(wh, start, end)
    measured = counters.select("stat_date", *_MEASURES)
    if history is not None:
        if start is None:
            raise ValueError("history needs a start date")
        earlier = (F.col("stat_date") >= F.lit(start - timedelta(days=30))) & (F.col("stat_date") < F.lit(start))
        measured = measured.unionByName(history.filter(earlier).select("stat_date", *_MEASURES))

    # each day counts towards the 30 days after it: a keyed aggregate, not one window over all days
    means = (
        measured.withColumn(
            "stat_date", F.explode(F.sequence(F.date_add("stat_date", 1), F.date_add("stat_date", 30)))
        )
        .groupBy("stat_date")
        .agg(*[exact_mean(F.col(m), kind).alias(f"mean_{m}") for m, kind in _MEASURES.items()])
    )
    c = F.col
    score = (
        F.lit(0.25) * capped_share(c("daily_sales"), c("mean_daily_sales"))
        + F.lit(0.20) * capped_share(c("active_users"), c("mean_active_users"))
        + F.lit(0.20) * capped_share(c("conversion_rate"), c("mean_conversion_rate"))
        + F.lit(0.20) * (1 - capped_share(c("refund_rate"), c("mean_refund_rate")))
        + F.lit(0.15) * capped_share(c("new_users"), c("mean_new_users"))
    )
    return (
        counters.join(means, "stat_date", "left")
        .withColumn("health_score_raw", score)
        .select(
            *counters.columns,
            F.round("health_score_raw", 0).alias("health_score"),
            "health_score_raw",
            is_true(c("daily_sales").cast("double") <= 0.8 * c("mean_daily_sales")).alias("sales_drop_warning"),
            is_true(c("conversion_rate") <= 0.9 * c("mean_conversion_rate")).alias("conversion_drop_warning"),
            is_true(c("refund_rate") >= 1.1 * c("mean_refund_rate")).alias("refund_spike_warning"),
        )
    )
