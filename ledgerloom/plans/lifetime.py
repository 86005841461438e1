"""What one load adds to the lifetime totals of users, products and merchants, and the stored totals themselves."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import whole_hours
from ledgerloom.operators.carried import CarriedTotals
from ledgerloom.operators.fold import stack
from ledgerloom.schemas import Warehouse
from ledgerloom.session import staged
from ledgerloom.sources.tables import LOAD_DATE

MONEY = "decimal(24,2)"


def loads(wh: Warehouse, after: date | None, upto: date) -> Warehouse:
    """The warehouse with only the facts loaded after one day and up to another; other load folders are not read."""

    def within(df: DataFrame) -> DataFrame:
        rows = df.filter(F.col(LOAD_DATE) <= F.lit(upto))
        return rows if after is None else rows.filter(F.col(LOAD_DATE) > F.lit(after))

    return replace(wh, orders=within(wh.orders), returns=within(wh.returns))


def user_part(load: Warehouse) -> DataFrame:
    one = F.lit(1).cast("bigint")
    return stack(
        load.orders.select("user_id", F.col("order_amount").alias("total_order_amount"), one.alias("total_order_count"), F.col("order_time").alias("last_order_date")),
        load.returns.select("user_id", one.alias("total_return_count")),
    )


def taste_part(load: Warehouse) -> DataFrame:
    """Purchases by user and category, counted per product before the category is looked up."""
    bought = load.orders.groupBy("user_id", "product_id").agg(F.count(F.lit(1)).alias("buy_count"))
    return bought.join(load.products.select("product_id", "category_name"), "product_id", "left").drop("product_id")


def product_part(load: Warehouse, orders: DataFrame) -> DataFrame:
    """orders: all stored ones, of which two columns tell a return's product.

    The load's returns are staged: the size of the few is known then, and all orders are read but not shuffled for them. Of a
    folder of a stored table Spark only knows the size of the whole table.
    """
    one = F.lit(1).cast("bigint")
    returned = staged(load.returns.select("order_id"), "load-returns").join(orders.select("order_id", "product_id"), "order_id")
    return stack(
        load.orders.select("product_id", F.col("order_amount").alias("total_sales_amount"), one.alias("total_sales_quantity")),
        returned.select("product_id", one.alias("total_return_times")),
    )


def merchant_part(load: Warehouse, daily: DataFrame) -> DataFrame:
    """daily: the rows of the merchant day table that the load's days have added."""
    c = F.col
    answered = F.coalesce("approved_time", "rejected_time")
    hours = whole_hours(c("apply_time"), answered)
    sent = load.orders.filter(c("shipping_time").isNotNull() & c("order_time").isNotNull())
    sent = sent.groupBy("product_id").agg(
        F.sum(whole_hours(c("order_time"), c("shipping_time"))).alias("ship_hours"), F.count(F.lit(1)).alias("ship_count")
    )
    return stack(
        daily.select("merchant_id", c("daily_sales").alias("total_sales_amount"), c("order_count").alias("total_order_count")),
        load.returns.select(
            "merchant_id", F.lit(1).cast("bigint").alias("total_return_count"), hours.alias("return_hours"), hours.isNotNull().cast("bigint").alias("return_answers")
        ),
        sent.join(load.products.select("product_id", "merchant_id"), "product_id").drop("product_id"),
    )


class Lifetime:
    """The four carried tables of a warehouse below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        def table(name: str, keys: list[str], sums: dict, maxima: dict | None = None) -> CarriedTotals:
            return CarriedTotals(spark, f"{root}/{name}", keys, sums, maxima)

        count = "bigint"
        self.users = table(
            "users", ["user_id"], {"total_order_amount": MONEY, "total_order_count": count, "total_return_count": count}, {"last_order_date": "timestamp"}
        )
        self.tastes = table("tastes", ["user_id", "category_name"], {"buy_count": count})
        self.products = table(
            "products", ["product_id"], {"total_sales_amount": MONEY, "total_sales_quantity": count, "total_return_times": count}
        )
        hours = dict.fromkeys(["total_order_count", "total_return_count", "return_hours", "return_answers", "ship_hours", "ship_count"], count)
        self.merchants = table("merchants", ["merchant_id"], {"total_sales_amount": MONEY, **hours})

    def advance(self, wh: Warehouse, daily: DataFrame, day: date, only: tuple[str, ...] = ("users", "tastes", "products", "merchants")) -> None:
        """Take in what was loaded on a day (the first time: up to that day), or the day's load again after a repeat.

        A product keeps its category and merchant: key repair gives a changed row an id of its own. Where a repeated load of
        products changes them nevertheless, the days that sold them are to be taken in again too.
        """
        done = [v for v in getattr(self, only[0]).versions() if v < day]
        load = loads(wh, done[-1] if done else None, day)
        days = daily.filter(F.col("stat_date") <= F.lit(day))
        if done:
            days = days.filter(F.col("stat_date") > F.lit(done[-1]))
        parts = {
            "users": lambda: user_part(load),
            "tastes": lambda: taste_part(load),
            "products": lambda: product_part(load, wh.orders),
            "merchants": lambda: merchant_part(load, days),
        }
        for name in only:
            getattr(self, name).advance(day, parts[name]())
