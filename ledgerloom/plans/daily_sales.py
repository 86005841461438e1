"""Daily sales and returns per merchant and category."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import between_days, ratio_or_zero, zero_if_null
from ledgerloom.schemas import Warehouse

KEYS = ["stat_date", "merchant_id", "category_id"]
MONEY = "decimal(20,2)"


def daily_sales(wh: Warehouse, start: date | None = None, end: date | None = None) -> DataFrame:
    """One row per day, merchant and category that sold or took back something; all days if unbounded."""
    products = wh.products.select("product_id", "merchant_id", F.col("product_category_id").alias("category_id"))

    # the join brings rows by product; where it splits a hot one, the window deals its days out
    of_product = Window.partitionBy("product_id", *KEYS).orderBy("product_id")
    sold = (
        between_days(wh.orders, "order_time", start, end)
        .select("product_id", "order_id", "user_id", "order_amount", F.to_date("order_time").alias("stat_date"))
        .join(products, "product_id")
        # the first row of a product and day stands for it: products are counted as a sum, without an expand of every row
        .withColumn("is_first", (F.row_number().over(of_product) == 1).cast("int"))
        .groupBy(*KEYS, "user_id")
        .agg(F.sum("order_amount").alias("amount"), F.count("order_id").alias("orders"), F.sum("is_first").alias("products"))
        .groupBy(*KEYS)
        .agg(
            F.sum("amount").alias("sales_amount"),
            F.sum("orders").alias("order_count"),
            F.count("user_id").alias("customer_count"),
            F.sum("products").alias("product_count"),
        )
    )
    returned = (
        between_days(wh.returns, "apply_time", start, end)
        .select("order_id", "return_id", "user_id", F.to_date("apply_time").alias("stat_date"))
        .join(wh.orders.select("order_id", "product_id", "order_amount"), "order_id")
        .join(products, "product_id")
        # one row per customer first: a plain second aggregate then counts customers without an expand
        .groupBy(*KEYS, "user_id")
        .agg(F.sum("order_amount").alias("amount"), F.count("return_id").alias("returns"))
        .groupBy(*KEYS)
        .agg(
            F.sum("amount").alias("return_amount"),
            F.sum("returns").alias("return_count"),
            F.count("user_id").alias("return_customer_count"),
        )
    )
    return sold.join(returned, KEYS, "full").select(
        *KEYS,
        zero_if_null(F.col("sales_amount"), MONEY).cast(MONEY).alias("sales_amount"),
        zero_if_null(F.col("order_count")).alias("order_count"),
        zero_if_null(F.col("customer_count")).alias("customer_count"),
        zero_if_null(F.col("product_count")).alias("product_count"),
        zero_if_null(F.col("return_amount"), MONEY).cast(MONEY).alias("return_amount"),
        zero_if_null(F.col("return_count")).alias("return_count"),
        zero_if_null(F.col("return_customer_count")).alias("return_customer_count"),
        (ratio_or_zero(zero_if_null(F.col("return_count")), F.col("order_count")) * 100).alias("return_rate"),
    )
