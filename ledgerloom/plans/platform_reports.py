"""Monthly and yearly platform reports and promotion effects."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import between_days, exact_mean, json_object, ratio
from ledgerloom.functions.months import ReportMonths, add_months
from ledgerloom.operators.latest import with_latest
from ledgerloom.plans.business_health import ACTIVE_ACTIONS
from ledgerloom.schemas import Warehouse
from ledgerloom.session import staged_alone

MONEY = "decimal(28,2)"
# Placeholder names for missing keys.
DEFAULT_LEVEL = "Normal"
UNKNOWN_CATEGORY = "Unknown"
# One year of one category as written in the JSON cell.
CATEGORY_JSON = "MAP<STRING, STRUCT<order_cnt: BIGINT, gmv: DECIMAL(28,2)>>"


def promotion_effect(wh: Warehouse, profile: DataFrame, months: ReportMonths) -> DataFrame:
    """Average order value with each running promotion against orders without one, per user level.

    Unrounded; the report rounds it. Orders are summed per user and promotion before the user's level is
    looked up, so a heavy buyer is one row per month and promotion.
    """
    c = F.col
    running = (
        months.spine(wh.promotions.filter(c("promotion_status") == "In Progress"))
        .filter((c("start_time") < c("stat_month")) & (c("end_time") >= F.add_months("stat_month", -1)))
        .select("stat_month", "promotion_id", "promotion_name")
    )
    spent = (
        months.measured(wh.orders, "order_time")
        .groupBy(months.label(c("order_time")), "user_id", "promotion_id")
        .agg(
            F.sum("order_amount").alias("amount"),
            F.count("order_amount").alias("priced"),
            F.count("order_id").alias("orders"),
        )
    )
    spent = (
        with_latest(spent, profile, "user_id", ["user_level"], months)
        .withColumn("user_level", F.coalesce("user_level", F.lit(DEFAULT_LEVEL)))
        .groupBy("stat_month", "promotion_id", "user_level")
        .agg(F.sum("amount").cast(MONEY).alias("gmv"), F.sum("priced").alias("priced"), F.sum("orders").alias("orders"))
        # decimal division, so that halves round up as money should
        .withColumn("mean", F.try_divide(c("gmv"), c("priced").cast("decimal(20,0)")))
    )
    # orders without a promotion are one row per month and level, spread over its promotions: orders are counted once for both
    level = Window.partitionBy("stat_month", "user_level")
    base = {"avg_order_amount_base": "mean", "base_order_cnt": "orders", "base_gmv": "gmv"}
    base = {name: F.max(F.when(c("promotion_id").isNull(), c(of))).over(level) for name, of in base.items()}
    promoted = spent.withColumns(base).join(running, ["stat_month", "promotion_id"])
    lift = F.when(
        c("avg_order_amount_base") > 0,
        ratio(c("avg_order_amount_promo") - c("avg_order_amount_base"), c("avg_order_amount_base")),
    )
    return promoted.select(
        "stat_month",
        "user_level",
        "promotion_id",
        "promotion_name",
        c("mean").alias("avg_order_amount_promo"),
        c("orders").alias("promo_order_cnt"),
        c("gmv").alias("promo_gmv"),
        *base,
    ).withColumn("lift", lift)


def promotion_detail(wh: Warehouse, profile: DataFrame, months: ReportMonths) -> DataFrame:
    """One row per report month, promotion and user level."""
    return promotion_effect(wh, profile, months).select(
        "stat_month",
        "promotion_id",
        "promotion_name",
        "user_level",
        F.round("avg_order_amount_promo", 2).cast("decimal(20,2)").alias("avg_order_amount_promo"),
        F.round("avg_order_amount_base", 2).cast("decimal(20,2)").alias("avg_order_amount_base"),
        F.round("lift", 4).alias("lift"),
        "promo_order_cnt",
        "base_order_cnt",
        "promo_gmv",
        "base_gmv",
    )


def category_sales_json(wh: Warehouse, months: ReportMonths) -> DataFrame:
    """Orders and value per category as one JSON object per month (one member per category)."""
    c = F.col
    per_category = (
        months.measured(wh.orders, "order_time")
        .groupBy(months.label(c("order_time")), "product_id")
        .agg(F.count("order_id").alias("orders"), F.sum("order_amount").alias("amount"))
        .join(wh.products.select("product_id", "category_name"), "product_id", "left")
        .groupBy("stat_month", F.coalesce("category_name", F.lit(UNKNOWN_CATEGORY)).alias("category"))
        .agg(F.sum("orders").alias("order_cnt"), F.sum("amount").cast(MONEY).alias("gmv"))
    )
    entry = F.struct("category", F.struct("order_cnt", "gmv").alias("value"))
    return per_category.groupBy("stat_month").agg(json_object(F.collect_list(entry)).alias("category_sales"))


def promotion_effect_json(effect: DataFrame) -> DataFrame:
    """All promotions of a month as one JSON object: promotion -> name and effects by user level."""
    c = F.col
    figures = F.struct(
        F.round("avg_order_amount_promo", 2).cast("decimal(20,2)").alias("avg_order_amount_promo"),
        F.round("avg_order_amount_base", 2).cast("decimal(20,2)").alias("avg_order_amount_base"),
        F.round("lift", 4).cast("decimal(20,4)").alias("lift"),
        "promo_order_cnt",
        "base_order_cnt",
        "promo_gmv",
        "base_gmv",
    )
    # levels and running promotions are short lists, one member each
    per_promotion = effect.groupBy("stat_month", "promotion_id").agg(
        F.struct(
            F.max("promotion_name").alias("promotion_name"),
            F.map_from_entries(
                F.array_sort(F.collect_list(F.struct(c("user_level"), figures.alias("figures"))))
            ).alias("effects"),
        ).alias("value")
    )
    # maps cannot be ordered, so the promotions are ordered by their key alone
    members = F.map_from_entries(
        F.array_sort(
            F.collect_list(F.struct("promotion_id", "value")),
            lambda a, b: F.when(a["promotion_id"] < b["promotion_id"], -1)
            .when(a["promotion_id"] > b["promotion_id"], 1)
            .otherwise(0),
        )
    )
    return per_promotion.groupBy("stat_month").agg(
        F.to_json(members, {"ignoreNullFields": "false"}).alias("promotion_effect")
    )


def platform_monthly(
    wh: Warehouse,
    daily: DataFrame,
    merchant_months: DataFrame,
    profile: DataFrame,
    months: ReportMonths,
    apart: bool = False,
) -> DataFrame:
    """One row per report month: totals, active merchants, category and promotion JSON.

    ``daily`` is the platform daily report; ``merchant_months`` the merchant monthly report, read at the
    label one month earlier. ``apart`` computes the report's parts one after the other in jobs of the call, each with a row a month,
    so that their shuffles of all facts do not add up on the disks; without it, a reader of some columns computes only their parts.
    """
    c = F.col
    totals = (
        daily.filter((c("stat_date") >= F.lit(months.data_start)) & (c("stat_date") < F.lit(months.last)))
        .groupBy(months.label(c("stat_date")))
        .agg(
            F.sum("daily_sales").cast(MONEY).alias("total_gmv"),
            F.sum("daily_orders").alias("total_orders"),
            F.sum("refund_count").alias("total_returns"),
            F.avg("health_score").alias("avg_health_score"),
            F.sum("new_users").alias("total_new_user"),
            exact_mean(c("conversion_rate"), "decimal(38,18)").alias("avg_conversion_rate"),
        )
    )
    active = (
        merchant_months.filter(
            (c("order_count") > 0)
            & c("stat_month").between(months.data_start, add_months(months.last, -1))
        )
        .groupBy(F.add_months("stat_month", 1).alias("stat_month"))
        .agg(F.countDistinct("merchant_id").alias("active_merchants"))
    )
    parts = {
        "totals": totals,
        "active": active,
        "categories": category_sales_json(wh, months),
        "promotions": promotion_effect_json(promotion_effect(wh, profile, months)),
    }
    if apart:
        parts = {name: staged_alone(part, f"platform-month-{name}") for name, part in parts.items()}
    return (
        months.table(daily.sparkSession)
        .join(parts["totals"], "stat_month", "left")
        .join(parts["active"], "stat_month", "left")
        .join(parts["categories"], "stat_month", "left")
        .join(parts["promotions"], "stat_month", "left")
        .select(
            "stat_month",
            "total_gmv",
            "total_orders",
            "total_returns",
            "avg_health_score",
            "total_new_user",
            "avg_conversion_rate",
            F.coalesce("active_merchants", F.lit(0)).cast("bigint").alias("active_merchants"),
            F.coalesce("category_sales", F.lit("{}")).alias("category_sales"),
            F.coalesce("promotion_effect", F.lit("{}")).alias("promotion_effect"),
        )
    )


def retention(wh: Warehouse, first_year: int, last_year: int) -> DataFrame:
    """Share of a year's January users also seen in December, in percent.

    One row per (year, user) holds both flags, so the two months are compared without a join.
    """
    c = F.col
    january, december = F.month("action_time") == 1, F.month("action_time") == 12
    seen = (
        between_days(wh.actions, "action_time", date(first_year, 1, 1), date(last_year, 12, 31))
        .filter(
            c("action_type").isin(ACTIVE_ACTIONS)
            & (january | december)
            & c("user_id").isNotNull()
        )
        .groupBy(F.year("action_time").alias("year"), "user_id")
        .agg(F.max(january.cast("int")).alias("jan"), F.max(december.cast("int")).alias("dec"))
        .groupBy("year")
        .agg(F.sum("jan").alias("jan"), F.sum(c("jan") * c("dec")).alias("kept"))
    )
    share = F.when(c("jan") == 0, F.lit(0.0)).otherwise(F.round(ratio(c("kept") * 100, c("jan")), 2))
    return seen.select("year", share.alias("user_retention_rate"))


def platform_yearly(
    wh: Warehouse, monthly: DataFrame, merchant_years: DataFrame, first_year: int, last_year: int | None = None
) -> DataFrame:
    """One row per year, named by the first day of the next year; sums the months labelled inside the year."""
    c = F.col
    last_year = last_year or first_year
    inside = monthly.filter(
        (c("stat_month") >= F.lit(date(first_year, 1, 1))) & (c("stat_month") < F.lit(date(last_year + 1, 1, 1)))
    ).withColumn("year", F.year("stat_month"))
    totals = inside.groupBy("year").agg(
        F.sum("total_gmv").cast(MONEY).alias("total_gmv"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_returns").alias("total_returns"),
        F.avg("avg_health_score").alias("avg_health_score"),
        F.sum("total_new_user").alias("total_new_user"),
        F.avg("avg_conversion_rate").alias("avg_conversion_rate"),
    )
    merged = (
        inside.filter(c("category_sales") != "{}")
        .select("year", F.explode(F.from_json("category_sales", CATEGORY_JSON)).alias("category", "month"))
        .groupBy("year", "category")
        .agg(F.sum("month.gmv").cast(MONEY).alias("gmv"), F.sum("month.order_cnt").alias("order_cnt"))
        .groupBy("year")
        .agg(
            json_object(
                F.collect_list(F.struct("category", F.struct("gmv", "order_cnt").alias("value")))
            ).alias("category_sales")
        )
    )
    active = (
        merchant_years.filter(c("stat_year").between(first_year, last_year) & (c("order_count") > 0))
        .groupBy(c("stat_year").alias("year"))
        .agg(F.countDistinct("merchant_id").alias("active_merchants"))
    )
    years = monthly.sparkSession.range(first_year, last_year + 1).select(c("id").cast("int").alias("year"))
    return (
        years.join(totals, "year", "left")
        .join(active, "year", "left")
        .join(merged, "year", "left")
        .join(retention(wh, first_year, last_year), "year", "left")
        .select(
            F.make_date(c("year") + 1, F.lit(1), F.lit(1)).alias("stat_year"),
            "total_gmv",
            "total_orders",
            "total_returns",
            "avg_health_score",
            "total_new_user",
            "avg_conversion_rate",
            F.coalesce("active_merchants", F.lit(0)).cast("bigint").alias("active_merchants"),
            F.coalesce("category_sales", F.lit("{}")).alias("category_sales"),
            F.coalesce("user_retention_rate", F.lit(0.0)).alias("user_retention_rate"),
        )
    )
