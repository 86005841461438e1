"""Lifetime totals that are carried from day to day instead of being counted anew.

Two stored tables: ``parts`` holds what each day's load adds per entity, ``totals`` the sums after each of the last days.
A day reads the totals of the day before and its own part. A repeated or late load changes the totals from its day on by
signed rows: what it adds now, less what it added before. Facts of other days are never read.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.fold import stack
from ledgerloom.session import remove, scratch_path
from ledgerloom.sources.tables import exists

PART, AS_OF, SIGN = "part_date", "as_of", "_sign"
#: In how many parts an entity occurs; one that is in none any more leaves the totals.
SEEN = "_parts"


def folder_dates(spark: SparkSession, path: str, column: str) -> list[date]:
    """Partition dates of a table, from its folder names."""
    if not exists(spark, path):
        return []
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop)
    names = [f.getPath().getName() for f in found]
    return sorted(date.fromisoformat(n.split("=")[1]) for n in names if n.startswith(f"{column}="))


class CarriedTotals:
    """Totals of one kind of entity below ``path``.

    ``sums`` and ``maxima`` map measures to their types. Sums can be taken back; a maximum that a repeated load takes back
    is looked up again in the parts of the entities that the load holds. ``keep``: how many days' totals stay.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], sums: dict[str, str], maxima: dict[str, str] | None = None, keep: int = 35):
        self.spark, self.path, self.keys, self.keep = spark, path.rstrip("/"), keys, keep
        self.sums, self.maxima = {**sums, SEEN: "bigint"}, maxima or {}

    @property
    def measures(self) -> list[str]:
        return [*self.sums, *self.maxima]

    def versions(self) -> list[date]:
        return folder_dates(self.spark, f"{self.path}/totals", AS_OF)

    def read(self, table: str, column: str, condition) -> DataFrame:
        """Rows of a table's folders that the condition on its partition column takes."""
        rows = self.spark.read.parquet(f"{self.path}/{table}").withColumn(column, F.col(column).cast("date"))
        return rows.filter(condition(F.col(column)))

    def totals(self, day: date) -> DataFrame:
        """Totals after a day: keys, measures."""
        return self.read("totals", AS_OF, lambda c: c == F.lit(day)).select(*self.keys, *[m for m in self.measures if m != SEEN])

    def summed(self, part: DataFrame) -> DataFrame:
        """A part as stored: one row per entity; entities are told apart with NULL as a value."""
        sums = [F.sum(F.col(m)).cast(kind).alias(m) for m, kind in self.sums.items() if m != SEEN]
        maxima = [F.max(F.col(m)).cast(kind).alias(m) for m, kind in self.maxima.items()]
        return part.groupBy(*self.keys).agg(*sums, F.lit(1).cast("bigint").alias(SEEN), *maxima)

    def changes(self, new: DataFrame, day: date) -> DataFrame:
        """The new part with sign 1 and the one that it replaces, if any, with sign -1."""
        signed = new.withColumn(SIGN, F.lit(1))
        if day not in folder_dates(self.spark, f"{self.path}/parts", PART):
            return signed
        old = self.read("parts", PART, lambda c: c == F.lit(day)).select(*self.keys, *self.measures)
        return signed.unionByName(old.withColumn(SIGN, F.lit(-1)))

    def corrected(self, new: DataFrame, day: date) -> DataFrame:
        """Totals of all kept days from ``day`` on, with the day's part replaced by the new one."""
        versions = self.versions()
        days = sorted({day, *(v for v in versions if v >= day)})
        earlier = [v for v in versions if v < day]
        dates = F.array(*[F.lit(d) for d in days])
        signed = self.changes(new, day)
        frames = [signed.withColumn(AS_OF, F.explode(dates))]
        if versions and days[-1] in versions:
            kept = self.read("totals", AS_OF, lambda c: c >= F.lit(day))
            frames.append(kept.select(*self.keys, *self.measures, AS_OF).withColumn(SIGN, F.lit(1)))
        if day not in versions and earlier:
            base = self.read("totals", AS_OF, lambda c: c == F.lit(earlier[-1])).select(*self.keys, *self.measures)
            frames.append(base.withColumns({AS_OF: F.lit(day), SIGN: F.lit(1)}))
        sign = F.col(SIGN)
        gone = {f"_gone_{m}": F.max(F.when(sign < 0, F.col(m))) for m in self.maxima}
        folded = stack(*frames).groupBy(*self.keys, AS_OF).agg(
            *[F.sum(F.col(m) * sign).cast(kind).alias(m) for m, kind in self.sums.items()],
            *[F.max(F.when(sign > 0, F.col(m))).alias(m) for m in self.maxima],
            *[c.alias(n) for n, c in gone.items()],
        )
        folded = folded.filter(F.col(SEEN) > 0)
        if not self.maxima or day not in folder_dates(self.spark, f"{self.path}/parts", PART):
            return folded.drop(*gone)  # nothing is taken back
        # a maximum that was as large as the one taken back may have come from there
        doubt = F.lit(False)
        for m in self.maxima:
            doubt = doubt | F.coalesce(F.col(f"_gone_{m}") >= F.col(m), F.lit(False))
        doubtful = folded.filter(doubt).select(*self.keys).distinct()
        others = self.read("parts", PART, lambda c: c != F.lit(day)).select(*self.keys, *self.maxima, PART)
        others = others.unionByName(new.select(*self.keys, *self.maxima).withColumn(PART, F.lit(day)))
        same = [others[k].eqNullSafe(doubtful[k]) for k in self.keys]
        looked = others.join(doubtful, same, "left_semi").withColumn(AS_OF, F.explode(dates)).filter(F.col(PART) <= F.col(AS_OF))
        looked = looked.groupBy(*[F.col(k).alias(f"_{k}") for k in self.keys], F.col(AS_OF).alias("_as_of")).agg(
            *[F.max(m).alias(f"_true_{m}") for m in self.maxima], F.lit(True).alias("_looked")
        )
        found = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys] + [F.col(AS_OF) == F.col("_as_of")]
        joined = folded.join(looked, found, "left")
        true = [F.when(F.col("_looked"), F.col(f"_true_{m}")).otherwise(F.col(m)).alias(m) for m in self.maxima]
        return joined.select(*self.keys, AS_OF, *self.sums, *true)

    def advance(self, day: date, part: DataFrame) -> None:
        """Take in a day's part (keys and measures, any number of rows per entity): its first load, a repeat, or a late one.

        The part and the totals are staged before either is replaced. Where a run dies between the two writes,
        ``rebuild`` sums the parts again.
        """
        scratch = scratch_path(self.spark, "carried")
        self.summed(part).write.parquet(f"{scratch}/part")
        new = self.spark.read.parquet(f"{scratch}/part")
        self.corrected(new, day).write.parquet(f"{scratch}/totals")
        self.replace("totals", self.spark.read.parquet(f"{scratch}/totals"), AS_OF, [v for v in self.versions() if v >= day])
        self.replace("parts", new.withColumn(PART, F.lit(day)), PART, [day])
        for old in self.versions()[: -self.keep]:
            remove(self.spark, f"{self.path}/totals/{AS_OF}={old}")
        remove(self.spark, scratch)

    def replace(self, table: str, rows: DataFrame, column: str, days: list[date]) -> None:
        """Write the rows' folders anew, and delete those of the given days that have no row any more."""
        writer = rows.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(column).parquet(f"{self.path}/{table}")
        filled = {r[0] for r in rows.select(F.col(column).cast("date")).distinct().collect()}
        for day in days:
            if day not in filled:
                remove(self.spark, f"{self.path}/{table}/{column}={day}")

    def rebuild(self, day: date) -> None:
        """The totals after a day from all parts, in place of what is stored."""
        parts = self.read("parts", PART, lambda c: c <= F.lit(day))
        sums = [F.sum(m).cast(kind).alias(m) for m, kind in self.sums.items()]
        folded = parts.groupBy(*self.keys).agg(*sums, *[F.max(m).alias(m) for m in self.maxima])
        self.replace("totals", folded.withColumn(AS_OF, F.lit(day)), AS_OF, [day])
