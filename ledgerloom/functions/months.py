"""Report months. A report month is named by the first day of the month after the one it measures."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import between_days, month_label


def add_months(day: date, n: int) -> date:
    months = day.year * 12 + day.month - 1 + n
    return date(months // 12, months % 12 + 1, 1)


def month_numbers(start: Column, end: Column) -> Column:
    """0, 1, … for the months from one month start up to another, which is left out and must be later.

    A sequence of dates would go through time stamps for each of its entries; ``add_months`` turns the numbers into dates.
    """
    length = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    return F.sequence(F.lit(0), length - 1)


@dataclass(frozen=True)
class ReportMonths:
    """Consecutive report months from ``first`` to ``last``, both month starts."""

    first: date
    last: date

    def __post_init__(self):
        if self.first.day != 1 or self.last.day != 1 or self.first > self.last:
            raise ValueError("report months must be month starts in order")

    @classmethod
    def one(cls, month: date) -> ReportMonths:
        return cls(month, month)

    @property
    def data_start(self) -> date:
        """First day measured."""
        return add_months(self.first, -1)

    def measured(self, df: DataFrame, ts: str) -> DataFrame:
        """Rows inside the measured months."""
        return between_days(df, ts, self.data_start, self.last - timedelta(days=1))

    def label(self, ts: Column) -> Column:
        return month_label(ts).alias("stat_month")

    def spine(self, df: DataFrame) -> DataFrame:
        dates = F.expr(f"sequence(DATE '{self.first}', DATE '{self.last}', INTERVAL 1 MONTH)")
        return df.withColumn("stat_month", F.explode(dates))

    def table(self, spark) -> DataFrame:
        return self.spine(spark.range(1)).select("stat_month")
