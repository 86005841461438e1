"""Monthly and yearly merchant reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import between_days, ordered_text, ratio, ratio_or_zero, zero_if_null
from ledgerloom.functions.months import ReportMonths, add_months
from ledgerloom.schemas import Warehouse

MONEY = "decimal(28,2)"
TOP_PRODUCTS = 5

# Sales trends.
RISING, FALLING, STEADY = "上升", "下降", "平稳"


def top_products(wh: Warehouse, months: ReportMonths) -> DataFrame:
    """Names of the five most ordered products per merchant and month, most ordered first.

    Merchants with fewer products get them all, which is the same list. Orders are counted per product
    before merchants are looked up, and the rank filter lets Spark keep five rows per merchant in each
    task ahead of the shuffle.
    """
    c = F.col
    counts = (
        months.measured(wh.orders, "order_time")
        .groupBy(months.label(c("order_time")), "product_id")
        .agg(F.count("order_id").alias("orders"))
        .join(wh.products.select("product_id", "merchant_id", "product_name"), "product_id")
    )
    order = [c("orders").desc(), c("product_name"), c("product_id")]
    ranked = counts.withColumn(
        "rank", F.row_number().over(Window.partitionBy("stat_month", "merchant_id").orderBy(*order))
    ).filter(c("rank") <= TOP_PRODUCTS)
    return ranked.groupBy("stat_month", "merchant_id").agg(
        ordered_text(F.collect_list(F.struct("rank", "product_name")), "product_name").alias("top_products")
    )


def merchant_monthly(
    wh: Warehouse, snapshots: DataFrame, months: ReportMonths, history: DataFrame | None = None
) -> DataFrame:
    """Month totals per merchant, customers, refund rate, top products and sales trend.

    ``snapshots`` is the merchant daily report with its history; a merchant appears in a month when it has
    a row on the month's label date. ``history`` is this table's earlier state (only the month before the
    first is read); later months compare with the months computed here.
    """
    c = F.col
    keys = ["stat_month", "merchant_id"]
    listed = snapshots.filter((F.dayofmonth("stat_date") == 1) & c("stat_date").between(months.first, months.last))
    listed = listed.select(c("stat_date").alias("stat_month"), "merchant_id", "merchant_name", "merchant_level")
    totals = (
        snapshots.filter((c("stat_date") >= F.lit(months.data_start)) & (c("stat_date") < F.lit(months.last)))
        .groupBy(months.label(c("stat_date")), "merchant_id")
        .agg(
            F.sum("daily_sales").cast(MONEY).alias("total_sales"),
            F.sum("order_count").alias("order_count"),
            F.sum("refund_count").alias("refund_count"),
        )
    )
    customers = (
        months.measured(wh.orders, "order_time")
        .select(months.label(c("order_time")), "product_id", "user_id")
        .distinct()
        .join(wh.products.select("product_id", "merchant_id"), "product_id")
        .groupBy(*keys)
        .agg(F.countDistinct("user_id").alias("customer_count"))
    )
    by_month = Window.partitionBy("merchant_id").orderBy("stat_month")
    consecutive = F.lag("stat_month").over(by_month) == F.add_months("stat_month", -1)
    compared = listed.join(totals, keys, "left").withColumn(
        "previous_sales", F.when(consecutive, F.lag("total_sales").over(by_month))
    )
    if history is not None:
        before = history.filter(c("stat_month") == F.lit(add_months(months.first, -1))).select(
            F.lit(months.first).alias("stat_month"), "merchant_id", c("total_sales").alias("stored_sales")
        )
        compared = compared.join(before, keys, "left").withColumn(
            "previous_sales", F.coalesce("previous_sales", "stored_sales")
        )
    joined = compared.join(customers, keys, "left").join(top_products(wh, months), keys, "left")
    base = F.coalesce(c("previous_sales").cast("double"), F.lit(0.0))
    sales = c("total_sales").cast("double")
    return joined.select(
        *keys,
        "merchant_name",
        "merchant_level",
        "total_sales",
        "order_count",
        zero_if_null(c("customer_count")).alias("customer_count"),
        "refund_count",
        ratio_or_zero(c("refund_count"), c("order_count")).alias("refund_rate"),
        F.coalesce("top_products", F.lit("")).alias("top_products"),
        F.when(sales > 1.2 * base, RISING).when(sales < 0.8 * base, FALLING).otherwise(STEADY).alias("sales_trend"),
    )


def merchant_yearly(
    wh: Warehouse, monthly: DataFrame, first_year: int, last_year: int | None = None, history: DataFrame | None = None
) -> DataFrame:
    """Year totals per merchant over the months labelled January to December, and growth on the year before.

    Customers are counted over the calendar year's orders. The highest level name of the year is kept,
    which is the worst level.
    """
    c = F.col
    last_year = last_year or first_year
    keys = ["stat_year", "merchant_id"]
    totals = (
        monthly.filter(
            (c("stat_month") >= F.lit(date(first_year, 1, 1))) & (c("stat_month") < F.lit(date(last_year + 1, 1, 1)))
        )
        .groupBy(F.year("stat_month").alias("stat_year"), "merchant_id")
        .agg(
            F.max("merchant_name").alias("merchant_name"),
            F.max("merchant_level").alias("merchant_level"),
            F.sum("total_sales").cast(MONEY).alias("total_sales"),
            F.sum("order_count").alias("order_count"),
            F.sum("refund_count").alias("refund_count"),
        )
    )
    customers = (
        between_days(wh.orders, "order_time", date(first_year, 1, 1), date(last_year, 12, 31))
        .select(F.year("order_time").alias("stat_year"), "product_id", "user_id")
        .distinct()
        .join(wh.products.select("product_id", "merchant_id"), "product_id")
        .groupBy(*keys)
        .agg(F.countDistinct("user_id").alias("customer_count"))
    )
    by_year = Window.partitionBy("merchant_id").orderBy("stat_year")
    consecutive = F.lag("stat_year").over(by_year) == c("stat_year") - 1
    compared = totals.withColumn("previous_sales", F.when(consecutive, F.lag("total_sales").over(by_year)))
    if history is not None:
        before = history.filter(c("stat_year") == first_year - 1).select(
            F.lit(first_year).alias("stat_year"), "merchant_id", c("total_sales").cast(MONEY).alias("stored_sales")
        )
        compared = compared.join(before, keys, "left").withColumn(
            "previous_sales", F.coalesce("previous_sales", "stored_sales")
        )
    growth = ratio(c("total_sales") - c("previous_sales"), c("previous_sales")) * 100
    return (
        compared.join(customers, keys, "left")
        .select(
            *keys,
            "merchant_name",
            "merchant_level",
            F.round("total_sales", 2).cast(MONEY).alias("total_sales"),
            "order_count",
            zero_if_null(c("customer_count")).alias("customer_count"),
            "refund_count",
            F.round(ratio_or_zero(c("refund_count"), c("order_count")), 4).alias("refund_rate"),
            F.round(growth, 2).alias("yoy_sales_growth"),
        )
    )
