"""Merchant day table: sales, period comparisons and alarms for every merchant and day."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import between_days, growth_percent, is_true, ratio_or_zero, zero_if_null
from ledgerloom.operators.fold import gathered, stack
from ledgerloom.schemas import Warehouse
from ledgerloom.session import staged_alone

MONEY = "decimal(20,2)"
COLUMNS = [
    "stat_date",
    "merchant_id",
    "daily_sales",
    "order_count",
    "customer_count",
    "refund_count",
    "sales_mom",
    "sales_yoy",
    "order_count_mom",
    "refund_rate",
    "abnormal_sales_flag",
    "zero_sales_flag",
]


def merchant_day_counters(wh: Warehouse, start: date, end: date) -> DataFrame:
    """Sales and refunds per merchant and day, zero-filled: every merchant with a product, every day.

    Counted days are staged for a range, so the call runs a job then: days are laid out from few rows wherever the table is
    read, and the shuffles of all orders are off the disks by then.
    """
    keys = ["stat_date", "merchant_id"]
    days = F.expr(f"sequence(DATE '{start}', DATE '{end}', INTERVAL 1 DAY)")
    members = wh.products.select("merchant_id", F.lit(True).alias("member")).distinct()
    sold = (
        between_days(wh.orders, "order_time", start, end)
        .select("product_id", "order_id", "user_id", "order_amount", F.to_date("order_time").alias("stat_date"))
        .join(wh.products.select("product_id", "merchant_id"), "product_id")
        # per customer first: hot merchants are spread by user, and no expand is needed for the distinct
        .groupBy(*keys, "user_id")
        .agg(F.sum("order_amount").alias("amount"), F.count("order_id").alias("orders"))
        .groupBy(*keys)
        .agg(
            F.sum("amount").alias("daily_sales"),
            F.sum("orders").alias("order_count"),
            F.count("user_id").alias("customer_count"),
        )
    )
    refunded = (
        between_days(wh.returns, "apply_time", start, end)
        .groupBy(F.to_date("apply_time").alias("stat_date"), "merchant_id")
        .agg(F.count("return_id").alias("refund_count"))
    )
    # days are laid out behind the exchange by merchant, which the comparisons of the days use too
    facts = stack(sold, refunded).filter(F.col("merchant_id").isNotNull())
    if start < end:
        facts = staged_alone(facts, "merchant-day-facts")
    day = F.explode(F.when(F.col("member"), days).otherwise(F.array("stat_date")))
    counters = ["daily_sales", "order_count", "customer_count", "refund_count"]
    return (
        gathered(stack(members, facts), "merchant_id")
        .withColumn("stat_date", day)
        .groupBy(*keys)
        .agg(F.max("member").alias("member"), *[F.max(m).alias(m) for m in counters])
        .filter("member")
        .select(
            *keys,
            zero_if_null(F.col("daily_sales"), MONEY).cast(MONEY).alias("daily_sales"),
            zero_if_null(F.col("order_count")).alias("order_count"),
            zero_if_null(F.col("customer_count")).alias("customer_count"),
            zero_if_null(F.col("refund_count")).alias("refund_count"),
        )
    )


def merchant_daily(
    wh: Warehouse, start: date, end: date | None = None, history: DataFrame | None = None
) -> DataFrame:
    """The merchant day table from ``start`` to ``end`` (default: one day).

    ``history`` is the table's earlier state; only the 30 days before ``start`` are read from it. A range
    computes its own later days' history, so it equals running the days one after the other.
    """
    end = end or start
    counters = merchant_day_counters(wh, start, end)
    rows = counters
    if history is not None:
        earlier = history.filter(
            (F.col("stat_date") >= F.lit(start - timedelta(days=30))) & (F.col("stat_date") < F.lit(start))
        ).select(*counters.columns)
        rows = counters.unionByName(earlier)

    by_day = Window.partitionBy("merchant_id").orderBy(F.unix_date("stat_date"))
    sales = F.col("daily_sales")

    def trailing(col: Column, zero: str) -> Column:
        """Sum over the 30 days before: two running sums, as a moving frame would be resummed for every row."""
        upto = F.sum(col).over(by_day.rangeBetween(Window.unboundedPreceding, -1))
        older = F.sum(col).over(by_day.rangeBetween(Window.unboundedPreceding, -31))
        return upto - F.coalesce(older, F.lit(0).cast(zero))

    # fixed-point sums keep the moments exact, so the alarm does not depend on the order of additions
    compared = rows.select(
        "*",
        F.max("daily_sales").over(by_day.rangeBetween(-1, -1)).alias("sales_d1"),
        F.max("order_count").over(by_day.rangeBetween(-1, -1)).alias("orders_d1"),
        F.max("daily_sales").over(by_day.rangeBetween(-7, -7)).alias("sales_d7"),
        trailing(F.lit(1), "bigint").alias("days30"),
        trailing(sales, MONEY).cast("decimal(22,2)").alias("sum30"),
        trailing(sales * sales, "decimal(38,4)").cast("decimal(38,4)").alias("squares30"),
    )
    days30 = F.nullif(F.col("days30"), F.lit(0))
    spread = F.col("squares30") * days30.cast("decimal(3,0)") - F.col("sum30") * F.col("sum30")
    compared = compared.withColumns(
        {
            "mean30": F.col("sum30").cast("double") / days30,
            "sigma30": F.sqrt(spread.cast("double")) / days30,
        }
    )
    if history is not None:
        compared = compared.filter(F.col("stat_date") >= F.lit(start))
    return compared.select(
        "stat_date",
        "merchant_id",
        "daily_sales",
        "order_count",
        "customer_count",
        "refund_count",
        growth_percent(sales, F.col("sales_d1")).alias("sales_mom"),
        growth_percent(sales, F.col("sales_d7")).alias("sales_yoy"),
        growth_percent(F.col("order_count"), F.col("orders_d1")).alias("order_count_mom"),
        (ratio_or_zero(F.col("refund_count"), F.col("order_count")) * 100).alias("refund_rate"),
        is_true(sales.cast("double") > F.col("mean30") + 3 * F.col("sigma30")).alias("abnormal_sales_flag"),
        (sales == 0).alias("zero_sales_flag"),
    )
