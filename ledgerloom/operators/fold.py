"""Combining many per-entity aggregates in one shuffle.

A profile table is a dozen aggregates over different facts, all keyed alike. Joining them costs one
exchange or broadcast each. Here every fact contributes rows with only its own measures filled; the union
is aggregated once, and Spark's map-side aggregation shrinks each fact before the only exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stack(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def fold(keys: list[str], measures: dict[str, Column], *frames: DataFrame) -> DataFrame:
    return stack(*frames).groupBy(*keys).agg(*[agg.alias(name) for name, agg in measures.items()])


def gathered(df: DataFrame, key: str) -> DataFrame:
    """Rows by key in all shuffle partitions. Adaptive execution would join partitions by the bytes they hold before each row
    is laid out into many dates, and one task would then sort all of those."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def running_totals(df: DataFrame, entity: list[str], order: str, sums: list[str], maxima: list[str] = ()) -> DataFrame:
    """Replace counters by their totals up to each row; the window holds one row per snapshot date."""
    upto = Window.partitionBy(*entity).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = {c: F.sum(c).over(upto) for c in sums} | {c: F.max(c).over(upto) for c in maxima}
    return df.withColumns(totals)
