"""Snapshot dates ("as of") for tables that restate running counters.

A snapshot table has one row per entity and date. Computing it date by date rereads the facts once
per date. Here each fact row is sent to the first snapshot that sees it, plus the ones whose look-back
window holds it, so any number of dates costs one pass; running totals are then summed over the dates.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONGEST_WINDOW = 30


@dataclass(frozen=True)
class Cutoffs:
    """One date, or the month starts from ``first`` to ``last``.

    ``open_end`` drops the upper bound: the last date counts every stored fact, also later ones.
    """

    first: date
    last: date
    open_end: bool = False

    @classmethod
    def on(cls, day: date, open_end: bool = False) -> Cutoffs:
        return cls(day, day, open_end)

    @classmethod
    def month_starts(cls, first: date, last: date) -> Cutoffs:
        if first.day != 1 or last.day != 1 or first > last:
            raise ValueError("month starts must be given in order, each on day 1")
        return cls(first, last)

    @property
    def single(self) -> bool:
        return self.first == self.last

    def first_seen(self, day: Column) -> Column:
        """The first snapshot whose day is not before ``day``; NULL after the last."""
        if self.single:
            return F.lit(self.last) if self.open_end else F.when(day <= F.lit(self.last), F.lit(self.last))
        start = F.trunc(day, "month")
        ceiling = F.when(start == day, start).otherwise(F.add_months(start, 1))
        return F.when(ceiling <= F.lit(self.last), F.greatest(ceiling, F.lit(self.first)))

    def spread(self, facts: DataFrame, day: Column) -> DataFrame:
        """Facts with ``as_of`` and ``is_new``: once where first seen, and once more for the next
        snapshot when its 30-day window still reaches back to the day."""
        seen = self.first_seen(day)
        if self.single:
            return facts.withColumn("as_of", seen).withColumn("is_new", F.lit(True)).filter(F.col("as_of").isNotNull())
        following = F.add_months(F.col("seen"), 1)
        reaches = (following <= F.lit(self.last)) & (F.date_sub(following, LONGEST_WINDOW) <= day)
        # both targets are written out and the one that does not reach is filtered: cheaper than compacting an array per fact
        targets = F.array(
            F.struct(F.col("seen").alias("as_of"), F.lit(True).alias("is_new")),
            F.struct(F.when(reaches, following).alias("as_of"), F.lit(False).alias("is_new")),
        )
        return (
            facts.withColumn("seen", seen)
            .filter(F.col("seen").isNotNull())
            .select("*", F.inline(targets))
            .filter(F.col("as_of").isNotNull())
            .drop("seen")
        )

    def grid(self, entities: DataFrame) -> DataFrame:
        """Every entity at every snapshot date."""
        if self.single:
            return entities.withColumn("as_of", F.lit(self.last))
        dates = F.expr(f"sequence(DATE '{self.first}', DATE '{self.last}', INTERVAL 1 MONTH)")
        return entities.withColumn("as_of", F.explode(dates))

    def contains(self, day: Column) -> Column:
        inside = (day >= F.lit(self.first)) & (day <= F.lit(self.last))
        return inside if self.single else inside & (F.dayofmonth(day) == 1)

    def upper(self) -> date | None:
        """Last day any snapshot looks at; None when unbounded."""
        return None if self.open_end else self.last

    def lower(self, days: int) -> date:
        return self.first - timedelta(days=days)


def in_window(day: Column, days: int, closed: bool = False, open_end: bool = False) -> Column:
    """as_of - days <= day < as_of; ``closed`` takes in the snapshot day, ``open_end`` all later days."""
    cond = day >= F.date_sub(F.col("as_of"), days)
    if open_end:
        return cond
    return cond & (day <= F.col("as_of") if closed else day < F.col("as_of"))
