"""The newest snapshot row of each entity as seen from each report month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.months import ReportMonths, month_numbers
from ledgerloom.operators.fold import gathered


def _by_month(profile: DataFrame, months: ReportMonths) -> DataFrame:
    """Snapshots with the first report month that sees them."""
    start = F.trunc("stat_date", "month")
    ceiling = F.when(start == F.col("stat_date"), start).otherwise(F.add_months(start, 1))
    return profile.withColumn("stat_month", F.greatest(ceiling, F.lit(months.first))).filter(
        F.col("stat_month") <= F.lit(months.last)
    )


def latest_snapshot(profile: DataFrame, entity: str, columns: list[str], months: ReportMonths) -> DataFrame:
    """(entity, stat_month, columns): values of the row with the greatest stat_date <= stat_month.

    Later months repeat the last known row. Of several months, one window orders an entity's rows by month and date, in the
    exchange that its source may have brought along; it holds the entity's snapshots.
    """
    rows = _by_month(profile, months)
    if months.first == months.last:
        newest = rows.groupBy(entity, "stat_month").agg(F.max_by(F.struct(*columns), "stat_date").alias("row"))
        return newest.select(entity, "stat_month", "row.*")
    in_order = Window.partitionBy(entity).orderBy("stat_month", "stat_date")
    following = F.lead("stat_month").over(in_order)
    newest = rows.select(entity, "stat_month", *columns, following.alias("following")).filter(
        F.col("following").isNull() | (F.col("following") > F.col("stat_month"))
    )
    until = F.coalesce("following", F.add_months(F.lit(months.last), 1))
    months_on = F.explode(month_numbers(F.col("stat_month"), until)).alias("n")
    repeated = newest.select(entity, "stat_month", *columns, months_on)
    return repeated.select(entity, F.add_months("stat_month", F.col("n")).alias("stat_month"), *columns)


def with_latest(facts: DataFrame, profile: DataFrame, entity: str, columns: list[str], months: ReportMonths) -> DataFrame:
    """Facts (entity, stat_month, …) with the columns of ``latest_snapshot``, NULL where there is no snapshot yet.

    Of several months, a window runs over an entity's snapshots and facts in order, so the months of all entities are neither
    laid out nor shuffled and sorted for a join with the few that have facts. Facts are dealt by the entity in all shuffle
    partitions, as the profile's snapshots are; the window holds one entity's rows. NULL entities have no snapshot.
    """
    c = F.col
    if months.first == months.last:
        return facts.join(latest_snapshot(profile, entity, columns, months), ["stat_month", entity], "left")
    measures = [name for name in facts.columns if name not in (entity, "stat_month")]
    # members of the other side are NULL as a whole: a snapshot is as narrow to sort as without facts
    snapshots = _by_month(profile, months).select(entity, "stat_month", "stat_date", F.struct(*columns).alias("_newest"))
    asked = gathered(facts.select(entity, "stat_month", F.struct(*measures).alias("_fact")), entity)
    in_order = Window.partitionBy(entity).orderBy("stat_month", c("_fact").isNotNull(), "stat_date")
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    newest = F.last("_newest", ignorenulls=True).over(upto)
    rows = snapshots.unionByName(asked, allowMissingColumns=True).withColumn("_newest", newest).filter(c("_fact").isNotNull())
    known = [F.when(c(entity).isNotNull(), c(f"_newest.{name}")).alias(name) for name in columns]
    return rows.select(entity, "stat_month", "_fact.*", *known)
