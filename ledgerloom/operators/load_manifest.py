"""What each load stored per event date, so that a late or repeated load names the days it changes."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import EVENT_DATE
from ledgerloom.session import remove, scratch_path
from ledgerloom.sources.tables import LOAD_DATE, exists, folder_names

ROWS, DIGEST, PENDING = "n_rows", "digest", "token"
SCHEMA = f"{EVENT_DATE} date, {ROWS} long, {DIGEST} decimal(38,0)"


@dataclass(frozen=True)
class Pending:
    """Event dates per table whose facts changed after their days may have been built, and the entries that say so."""

    tokens: list[str]
    days: dict[str, list[date]]


class LoadManifest:
    """Row counts and order-free digests by table, load and event date, below ``path``.

    ``announce`` comes before a load's rows are replaced, ``settle`` after. A load that stops in between leaves its dates without
    a digest, which differs from every digest: its repeat names them all again, also those that have no row any more.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, table: str, load: date) -> str:
        return f"{self.path}/stored/{table}/{LOAD_DATE}={load}"

    def _covered(self, rows: DataFrame, day: Column) -> DataFrame:
        """One row per event date; a map-side sum, so a day that holds most rows is one row per task."""
        told = F.xxhash64(*[F.col(c) for c in sorted(rows.columns)]).cast("decimal(20,0)")
        counted = rows.groupBy(day.cast("date").alias(EVENT_DATE))
        return counted.agg(F.count(F.lit(1)).alias(ROWS), F.sum(told).cast("decimal(38,0)").alias(DIGEST))

    def _stored(self, table: str, load: date) -> DataFrame:
        folder = self._folder(table, load)
        if not exists(self.spark, folder):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(folder)

    def announce(self, table: str, load: date, rows: DataFrame, day: Column) -> str:
        """Note the event dates that the load is going to change; equal rows again change none.

        Gives back where the new counts are staged, for ``settle``: the rows are read once.
        """
        old = self._stored(table, load).select(F.col(EVENT_DATE).alias("_day"), F.col(ROWS).alias("_n"), F.col(DIGEST).alias("_digest"))
        both = self._covered(rows, day).join(old, F.col(EVENT_DATE).eqNullSafe(F.col("_day")), "full")
        equal = F.coalesce((F.col(ROWS) == F.col("_n")) & (F.col(DIGEST) == F.col("_digest")), F.lit(False))
        scratch = scratch_path(self.spark, "manifest")
        both.select(F.coalesce(EVENT_DATE, "_day").alias(EVENT_DATE), ROWS, DIGEST, equal.alias("_equal")).write.parquet(scratch)
        seen = self.spark.read.parquet(scratch)
        changed = seen.filter(F.col(EVENT_DATE).isNotNull() & ~F.col("_equal")).select(F.lit(table).alias("table"), EVENT_DATE)
        changed.coalesce(1).write.parquet(f"{self.path}/pending/{PENDING}={uuid.uuid4().hex}")
        open_days = seen.select(EVENT_DATE, F.lit(None).cast("long").alias(ROWS), F.lit(None).cast("decimal(38,0)").alias(DIGEST))
        open_days.coalesce(1).write.mode("overwrite").parquet(self._folder(table, load))
        return scratch

    def settle(self, table: str, load: date, staged: str) -> None:
        """Note that the announced rows are stored."""
        new = self.spark.read.parquet(staged).filter(F.col(ROWS).isNotNull()).select(EVENT_DATE, ROWS, DIGEST)
        new.coalesce(1).write.mode("overwrite").parquet(self._folder(table, load))
        remove(self.spark, staged)

    def pending(self) -> Pending:
        """What has changed since the last ``done``; one entry per table and event date comes to the driver."""
        tokens = folder_names(self.spark, f"{self.path}/pending", PENDING)
        if not tokens:
            return Pending([], {})
        paths = [f"{self.path}/pending/{PENDING}={t}" for t in tokens]
        rows = self.spark.read.schema(f"table string, {EVENT_DATE} date").parquet(*paths).distinct()
        days: dict[str, list[date]] = {}
        for table, day in sorted(tuple(r) for r in rows.collect()):
            days.setdefault(table, []).append(day)
        return Pending(tokens, days)

    def done(self, pending: Pending) -> None:
        """The days of these entries are rebuilt; entries noted meanwhile stay."""
        for token in pending.tokens:
            remove(self.spark, f"{self.path}/pending/{PENDING}={token}")
