"""Stored tables: Parquet folders, facts and snapshots partitioned by their date column."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import EVENT_DATE
from ledgerloom.schemas import TableSpec
from ledgerloom.session import remove, scratch_path

# Partition column of stored loads: the day of the extract.
LOAD_DATE = "load_date"


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def folder_names(spark: SparkSession, path: str, column: str) -> list[str]:
    """Partition values of a table as written in its folder names, in order."""
    if not exists(spark, path):
        return []
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop_path)
    names = [f.getPath().getName() for f in found]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def remove_load(spark: SparkSession, path: str, spec: TableSpec, load: date) -> None:
    """Delete what an earlier try of a load has stored."""
    remove(spark, "/".join([path, *[f"{EVENT_DATE}=*"] * (spec.event_time is not None), f"{LOAD_DATE}={load}"]))


def append_clean(
    df: DataFrame, path: str, spec: TableSpec, loaded_at: datetime | None = None, load: date | None = None
) -> None:
    """Append cleaned rows with the table's types; facts go to the folder of their event date.

    ``load`` names the extract day: its rows go to folders of their own below that, and what an earlier try of the same load
    left there is removed first, so a load can be repeated. The rebalance hint gathers each folder into few
    files and splits one that is too large for one task.
    """
    stamp = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    rows = df.select(
        *[F.col(c).cast(kind).alias(c) for c, kind in spec.types.items()], *[stamp.alias(c) for c in spec.stamps]
    )
    folders = []
    if spec.event_time is not None:
        rows = rows.withColumn(EVENT_DATE, F.to_date(spec.event_time))
        folders.append(EVENT_DATE)
    if load is not None:
        rows = rows.withColumn(LOAD_DATE, F.lit(load))
        folders.append(LOAD_DATE)
        remove_load(df.sparkSession, path, spec, load)
    if not folders:
        rows.write.mode("append").parquet(path)
        return
    rows.hint("rebalance", folders[0]).write.mode("append").partitionBy(*folders).parquet(path)


def overwrite(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Replace a table by a result that does not read it."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def merged(existing: DataFrame | None, new: DataFrame, keys: list[str], replaced: bool = True) -> DataFrame:
    """New rows replace stored rows of the same key; other rows stay. Without ``replaced``, only the rows that stay."""
    if existing is None:
        return new
    # NULL-safe, so that a row with an empty key cell replaces itself on a rerun
    kept = existing.alias("old").join(
        new.select(*[F.col(k).alias(f"_new_{k}") for k in keys]),
        [F.col(f"old.{k}").eqNullSafe(F.col(f"_new_{k}")) for k in keys],
        "left_anti",
    )
    return kept.unionByName(new.select(*existing.columns)) if replaced else kept


def untouched_rows(path: str, new: DataFrame, keys: list[str], values: list) -> DataFrame:
    """Stored rows of the given partitions whose key is not among the new rows.

    The partitions are literals, so that no other folder is read.
    """
    # Spark would infer another type from folder names; the new rows know it
    table = new.sparkSession.read.schema(new.schema).parquet(path)
    inside = F.col(keys[0]).isin([v for v in values if v is not None])
    return merged(table.filter(inside | F.col(keys[0]).isNull() if None in values else inside), new, keys, replaced=False)


def upsert(new: DataFrame, path: str, keys: list[str]) -> None:
    """Keyed upsert into a table partitioned by its first key (a date or year).

    Only partitions the new rows touch are read and rewritten. New rows and the rows that stay beside them are staged
    first, so the table is never read while its folders are being replaced, and a lost executor cannot mix the two.
    """
    spark, partition = new.sparkSession, keys[0]
    scratch = scratch_path(spark, "upsert")
    new.write.parquet(f"{scratch}/new")
    rows = spark.read.schema(new.schema).parquet(f"{scratch}/new")
    # one value per date or year that the new rows cover
    values = [row[0] for row in rows.select(partition).distinct().collect()]
    if values:
        if exists(spark, path):
            untouched_rows(path, rows, keys, values).write.parquet(f"{scratch}/stay")
            rows = rows.unionByName(spark.read.schema(new.schema).parquet(f"{scratch}/stay"))
        (
            rows.hint("rebalance", partition)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(path)
        )
    remove(spark, scratch)


def replace_days(new: DataFrame, path: str, partition: str, days: list[date]) -> None:
    """Put the new rows in place of all that is stored of some days; a day without a new row is deleted.

    ``new`` must hold no other days. It may read the table: its rows are staged before a folder is touched.
    """
    spark = new.sparkSession
    scratch = scratch_path(spark, "replace")
    new.write.parquet(scratch)
    rows = spark.read.schema(new.schema).parquet(scratch)
    filled = {row[0] for row in rows.select(partition).distinct().collect()}
    if filled:
        writer = rows.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(partition).parquet(path)
    for day in days:
        if day not in filled:
            remove(spark, f"{path}/{partition}={day}")
    remove(spark, scratch)


def stored(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame | None:
    """A table's present state, or None before its first run."""
    if not exists(spark, path):
        return None
    return spark.read.schema(like.schema).parquet(path) if like is not None else spark.read.parquet(path)
