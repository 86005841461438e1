"""An index of stored ids for key conflicts, so that a load does not scan the ids of all earlier loads.

One row holds a run of used numbers of a base: number 0 is the base itself as a stored id, number n the id ``<base><suffix><n>``. Rows
lie in folders by a hash of their base and by load; a load reads only the folders of the bases it brings.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.keys import RANGE_BITS, ranked_suffixes, running_before, taken_suffixes
from ledgerloom.session import remove
from ledgerloom.sources.tables import LOAD_DATE, exists

BUCKET = "key_bucket"
SCHEMA = f"base string, first long, last long, {BUCKET} int, {LOAD_DATE} date"


class KeyIndex:
    """The used ids of one table at a path. ``buckets`` is fixed when the index is made: a load's share should fill a file."""

    def __init__(self, spark: SparkSession, path: str, suffix: str = "_new", buckets: int = 64):
        self.spark, self.path, self.suffix, self.buckets = spark, path, suffix, buckets

    def exists(self) -> bool:
        return exists(self.spark, self.path)

    def _bucket(self, base: str) -> Column:
        return F.pmod(F.xxhash64(base), F.lit(self.buckets)).cast("int")

    def add(self, ids: DataFrame, key: str, load: date) -> None:
        """Take in the ids of a load; what an earlier try of it left is removed first."""
        self.drop(load)
        self._write(self._runs(ids.select(F.col(key).cast("string").alias("id"))).withColumn(LOAD_DATE, F.lit(load)))

    def build(self, stored: DataFrame, key: str) -> None:
        """The index of a table that was stored without one; ``stored`` tells the load of each row."""
        loads = stored.select(F.col(key).cast("string").alias("id"), F.col(LOAD_DATE).cast("date"))
        self._write(self._runs(loads, LOAD_DATE))

    def drop(self, load: date) -> None:
        remove(self.spark, f"{self.path}/{BUCKET}=*/{LOAD_DATE}={load}")

    def _runs(self, ids: DataFrame, *by: str) -> DataFrame:
        itself = ids.select(F.col("id").alias("base"), F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("last"), *by).distinct()
        taken = taken_suffixes(ids.filter(F.col("id").contains(self.suffix)), self.suffix, *by)
        islands = ranked_suffixes(taken, *by).groupBy("base", *by, (F.col("taken") - F.col("place")).alias("_island"))
        runs = islands.agg(F.min("taken").alias("first"), F.max("taken").alias("last")).drop("_island")
        return itself.unionByName(runs).withColumn(BUCKET, self._bucket("base"))

    def _write(self, runs: DataFrame) -> None:
        runs.hint("rebalance", BUCKET).write.mode("append").partitionBy(BUCKET, LOAD_DATE).parquet(self.path)

    def entries(self, batch: DataFrame, but: date | None = None) -> DataFrame:
        """Stored runs (base, first, last) in the folders that the ids of a batch (id) fall into.

        The folders are literals, at most one for each bucket, so files of other ones are not opened. ``but``: a load to leave out.
        """
        if not self.exists():
            return self.spark.createDataFrame([], "base string, first long, last long")
        hit = [row[0] for row in batch.select(self._bucket("id")).distinct().collect()]
        rows = self.spark.read.schema(SCHEMA).parquet(self.path).filter(F.col(BUCKET).isin(hit))
        return (rows if but is None else rows.filter(F.col(LOAD_DATE) != F.lit(but))).select("base", "first", "last")

    def resolve(
        self, df: DataFrame, key: str, but: date | None = None, make_id: Callable[[Column, Column], Column] | None = None
    ) -> DataFrame:
        """``resolve_conflicts`` from the index: stored ids become ``<id><suffix><number>`` with the first free number.

        Ids of ``df`` must be unique. A number is free if neither the index nor the batch uses it: runs are put in order, the running maximum
        of their ends shows the first gap. A base with very many runs is worked on in ranges by many tasks.
        """
        batch = df.select(F.col(key).cast("string").alias("id"))
        known = self.entries(batch, but).join(batch, F.col("base") == F.col("id"), "left_semi")
        clashing = known.filter("first = 0").select(F.col("base").alias("_clash")).distinct()
        if make_id is not None:
            targets = clashing.withColumn("_free", F.lit(1))
            new = make_id(F.col(key), F.col("_free"))
        else:
            own = taken_suffixes(batch.filter(F.col("id").contains(self.suffix)), self.suffix)
            own = own.select("base", F.col("taken").alias("first"), F.col("taken").alias("last"))
            runs = known.filter("first > 0").unionByName(own).join(clashing, F.col("base") == F.col("_clash"), "left_semi")
            runs = runs.withColumn("_range", F.shiftright("first", RANGE_BITS))
            zero = F.lit(0).cast("bigint")
            runs = running_before(runs, ["base"], "_range", ["first", "last"], F.col("last"), F.max, zero, "_covered")
            gap = F.min(F.when(F.col("first") > F.col("_covered") + 1, F.col("_covered") + 1))
            free = runs.groupBy("base").agg(F.coalesce(gap, F.max("last") + 1).alias("_number"))
            targets = clashing.join(free, F.col("_clash") == F.col("base"), "left").select("_clash", F.coalesce("_number", F.lit(1)).alias("_free"))
            new = F.concat(F.col(key), F.lit(self.suffix), F.col("_free").cast("string"))
        fixed = F.when(F.col("_free").isNotNull(), new).otherwise(F.col(key))
        return df.join(targets, F.col(key) == F.col("_clash"), "left").withColumn(key, fixed).select(*df.columns)
