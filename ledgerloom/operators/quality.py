"""Checks on cleaned tables; the violations are DataFrames, the summary is an alert table."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.schemas import Warehouse


class QualityError(RuntimeError):
    """A blocking check found violations."""


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-empty key has no parent."""
    known = parent.select(F.col(parent_column).alias("_known")).distinct()
    keyed = child.filter(F.col(column).isNotNull())
    return keyed.join(known, F.col(column) == F.col("_known"), "left_anti")


def missing_cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: how many cells are NULL, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing")) for c in columns]))
    return counts.select(pairs.alias("p")).select("p.*")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def refund_violations(wh: Warehouse) -> DataFrame:
    """Returns that refund more than the order was worth, or that precede their order."""
    joined = wh.returns.select("return_id", "order_id", "refund_amount", "apply_time").join(
        wh.orders.select("order_id", "order_amount", "order_time"), "order_id"
    )
    too_much = F.col("refund_amount") > F.col("order_amount")
    too_early = F.col("apply_time") <= F.col("order_time")
    broken = F.array_compact(
        F.array(F.when(too_much, F.lit("refund_above_amount")), F.when(too_early, F.lit("return_before_order")))
    )
    return joined.select("return_id", "order_id", F.explode(broken).alias("rule"))


def order_time_violations(orders: DataFrame, later: str) -> DataFrame:
    """Orders with a step before the order itself."""
    return orders.filter(F.col(later) < F.col("order_time")).select("order_id", "order_time", later)


def alert(check_type: str, description: str, found: DataFrame, severity: str, data_date: date) -> DataFrame:
    """One alert row with the number of violations; no row when there are none."""
    return (
        found.agg(F.count(F.lit(1)).alias("problem_count"))
        .filter(F.col("problem_count") > 0)
        .select(
            F.lit(check_type).alias("check_type"),
            F.lit(description).alias("problem_description"),
            "problem_count",
            F.lit(severity).alias("severity"),
            F.lit(datetime.combine(data_date, datetime.min.time())).cast("timestamp").alias("check_time"),
            F.lit(data_date).alias("data_date"),
            F.lit(0).alias("resolved"),
            F.lit(None).cast("string").alias("resolution_notes"),
            F.lit(None).cast("timestamp").alias("resolved_time"),
        )
    )


def warehouse_alerts(wh: Warehouse, data_date: date) -> DataFrame:
    """All standard checks as alert rows."""
    late = order_time_violations(wh.orders, "shipping_time")
    checks = [
        ("referential_integrity", "returns without order", orphans(wh.returns, "order_id", wh.orders, "order_id"), "critical"),
        ("missing_values", "orders without user", wh.orders.filter(F.col("user_id").isNull()), "high"),
        ("missing_values", "orders without order id", wh.orders.filter(F.col("order_id").isNull()), "critical"),
        ("duplicates", "order ids stored twice", repeated_keys(wh.orders, "order_id"), "critical"),
        ("duplicates", "return ids stored twice", repeated_keys(wh.returns, "return_id"), "critical"),
        ("outliers", "refunds that break a rule", refund_violations(wh), "medium"),
        ("outliers", "orders shipped before they were placed", late, "low"),
    ]
    return reduce(DataFrame.unionByName, [alert(t, text, df, s, data_date) for t, text, df, s in checks])


def gate(alerts: DataFrame) -> DataFrame:
    """Stop the run on critical alerts; a handful of rows at most, one per check."""
    blocking = alerts.filter(F.col("severity") == "critical").select("problem_description", "problem_count").collect()
    if blocking:
        raise QualityError("; ".join(f"{r.problem_description}: {r.problem_count}" for r in blocking))
    return alerts
