"""Product summary: lifetime and 7-day sales and returns, stock turnover and overstock flags."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import between_days, is_true, ratio_or_zero, within_days, zero_if_null
from ledgerloom.operators.changes import changed_products
from ledgerloom.operators.fold import fold, running_totals
from ledgerloom.schemas import Warehouse
from ledgerloom.session import staged

MONEY = "decimal(24,2)"


def product_rows(counted: DataFrame) -> DataFrame:
    """The table's columns from products with stat_date and counters."""
    c = F.col
    week = zero_if_null(c("last_7d_sales_quantity"))
    turnover = F.when(week > 0, c("current_stock").cast("double") / (week.cast("double") / F.lit(7.0)))
    return (
        counted.withColumn("stock_turnover_days", turnover)
        .select(
            "stat_date",
            "product_id",
            "merchant_id",
            "product_name",
            c("product_category_id").alias("category_id"),
            "category_name",
            c("listing_time").alias("shelf_time"),
            "product_status",
            c("updated_time").alias("last_status_change"),
            zero_if_null(c("total_sales_amount"), MONEY).cast(MONEY).alias("total_sales_amount"),
            zero_if_null(c("total_sales_quantity")).alias("total_sales_quantity"),
            "current_stock",
            "stock_turnover_days",
            zero_if_null(c("total_return_times")).alias("total_return_times"),
            ratio_or_zero(zero_if_null(c("total_return_times")), c("total_sales_quantity")).alias("return_rate"),
            week.alias("last_7d_sales_quantity"),
            zero_if_null(c("last_7d_return_times")).alias("last_7d_return_times"),
            is_true(c("stock_turnover_days") > 15).alias("stock_over_15d_flag"),
            is_true(c("stock_turnover_days") > 30).alias("stock_over_30d_flag"),
        )
    )


def product_summary(wh: Warehouse, day: date, changed_only: bool = False, carried: DataFrame | None = None) -> DataFrame:
    """One row per product for ``day``; lifetime counters cover every stored order and return.

    ``changed_only`` is the incremental form: products touched since 30 days before ``day``. ``carried``
    (``Lifetime.products`` after the day) replaces the count over all facts, of which only the last week is read then, and
    of orders the two columns that tell a return's product. The week's returns are staged, so that their size is known
    and all orders are not shuffled for a few of them.
    """
    c = F.col
    first, last = day - timedelta(days=7), day - timedelta(days=1)
    products, orders, returns = wh.products, wh.orders, wh.returns
    recent = orders
    if changed_only:
        changed = changed_products(wh, day)
        products, orders = (df.join(changed, "product_id", "left_semi") for df in (products, orders))
        recent = orders
    if carried is not None:
        recent, returns = between_days(orders, "order_time", first, last), between_days(returns, "apply_time", first, last)
    # grouped by the join key first: a best seller reaches the product join as one row
    sold = recent.groupBy("product_id").agg(
        F.sum("order_amount").alias("total_sales_amount"),
        F.count("order_id").alias("total_sales_quantity"),
        F.count(F.when(within_days(c("order_time"), first, last), c("order_id"))).alias("last_7d_sales_quantity"),
    )
    returns = returns.select("order_id", "return_id", "apply_time")
    if carried is not None:
        returns = staged(returns, "week-returns")
    returned = (
        returns.join(orders.select("order_id", "product_id"), "order_id")
        .groupBy("product_id")
        .agg(
            F.count("return_id").alias("total_return_times"),
            F.count(F.when(within_days(c("apply_time"), first, last), c("return_id"))).alias("last_7d_return_times"),
        )
    )
    counted = products.withColumn("stat_date", F.lit(day))
    if carried is not None:
        counted = counted.join(carried, "product_id", "left")
        sold, returned = sold.select("product_id", "last_7d_sales_quantity"), returned.select("product_id", "last_7d_return_times")
    return product_rows(counted.join(sold, "product_id", "left").join(returned, "product_id", "left"))


def product_summary_days(wh: Warehouse, first: date, last: date) -> DataFrame:
    """The product summary of every day of a range, as a run on that day would have made it, in one pass over the facts.

    Each fact adds to the lifetime counters from its day on, enters the 7-day counters on the next day and leaves
    them on the eighth; summed over the days these signed rows give each day's counters. What happened before the
    range comes in on its first day. A product's running sums hold one row per day of the range.
    """
    c = F.col
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def signed(facts: DataFrame, life: list[str], week: str) -> DataFrame:
        """life: counters of a fact (columns); week: the name of its 7-day counter."""
        enters, leaves = F.date_add("day", 1), F.date_add("day", 8)
        nothing = [F.lit(None).cast(facts.schema[m].dataType).alias(m) for m in life]
        begins = F.struct(F.greatest(c("day"), F.lit(first)).alias("stat_date"), *life, zero.alias(week))
        inside = (enters <= F.lit(last)) & (leaves > F.lit(first))
        entry = F.when(inside, F.struct(F.greatest(enters, F.lit(first)).alias("stat_date"), *nothing, one.alias(week)))
        exit_ = F.when(inside & (leaves <= F.lit(last)), F.struct(leaves.alias("stat_date"), *nothing, (-one).alias(week)))
        return facts.select("product_id", F.inline(F.array_compact(F.array(begins, entry, exit_))))

    sold = between_days(wh.orders, "order_time", None, last).select(
        "product_id", F.to_date("order_time").alias("day"), c("order_amount").alias("total_sales_amount"), one.alias("total_sales_quantity")
    )
    returned = between_days(wh.returns, "apply_time", None, last).select("order_id", F.to_date("apply_time").alias("day"))
    returned = returned.join(wh.orders.select("order_id", "product_id"), "order_id").select("product_id", "day", one.alias("total_return_times"))
    dates = F.expr(f"sequence(DATE '{first}', DATE '{last}')")
    counters = ["total_sales_amount", "total_sales_quantity", "total_return_times", "last_7d_sales_quantity", "last_7d_return_times"]
    folded = fold(
        ["product_id", "stat_date"],
        {m: F.sum(m) for m in counters},
        wh.products.select("product_id", F.explode(dates).alias("stat_date")),
        signed(sold, ["total_sales_amount", "total_sales_quantity"], "last_7d_sales_quantity"),
        signed(returned, ["total_return_times"], "last_7d_return_times"),
    )
    return product_rows(wh.products.join(running_totals(folded, ["product_id"], "stat_date", counters), "product_id"))
