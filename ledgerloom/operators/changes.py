"""Entities touched lately, found before the heavy aggregates run."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.schemas import Warehouse

CHANGE_WINDOW = 30


def touched_since(sources: list[tuple[DataFrame, str, str]], key: str, day: date) -> DataFrame:
    """Distinct keys over (table, key column, time column) sources, from 30 days before ``day`` on."""
    since = F.lit(day - timedelta(days=CHANGE_WINDOW)).cast("timestamp")
    parts = [df.filter(F.col(ts) >= since).select(F.col(col).alias(key)).distinct() for df, col, ts in sources]
    return reduce(DataFrame.union, parts).filter(F.col(key).isNotNull()).distinct()


def changed_users(wh: Warehouse, day: date) -> DataFrame:
    return touched_since(
        [
            (wh.users, "user_id", "updated_time"),
            (wh.orders, "user_id", "order_time"),
            (wh.returns, "user_id", "apply_time"),
            (wh.actions, "user_id", "action_time"),
        ],
        "user_id",
        day,
    )


def changed_products(wh: Warehouse, day: date) -> DataFrame:
    since = F.lit(day - timedelta(days=CHANGE_WINDOW)).cast("timestamp")
    returned = (
        wh.returns.filter(F.col("apply_time") >= since)
        .select("order_id", "apply_time")
        .join(wh.orders.select("order_id", "product_id"), "order_id")
        .join(wh.products.select("product_id"), "product_id", "left_semi")
    )
    return touched_since(
        [
            (wh.products, "product_id", "updated_time"),
            (wh.orders, "product_id", "order_time"),
            (returned, "product_id", "apply_time"),
        ],
        "product_id",
        day,
    )
