"""Primary-key repair: new ids for repeated rows and for rows whose id is already stored.

Ids may repeat without limit, so no step puts all rows of one id into one task: rows are numbered inside
(id, bucket) groups and the bucket sizes in front are added.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import staged_alone

# a used number: 18 digits at most, as no id repeats more often than that
NUMBER = r"[1-9][0-9]{0,17}"
RANGE_BITS = 16
RUN = 10_000


def row_digest(columns: list[str]) -> Column:
    """A text that orders rows of one id the same way in every run."""
    return F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in columns]))


def number_rows(df: DataFrame, keys: list[str], bucket: Column, order: list[str], name: str) -> DataFrame:
    """Row numbers from 1 within ``keys``. ``bucket`` must never decrease along ``order``."""
    df = df.withColumn("_bucket", bucket)
    cells = [*keys, "_bucket"]
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*cells)
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(*cells, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    )
    local = F.row_number().over(Window.partitionBy(*cells).orderBy(*order))
    return (
        df.withColumn("_local", local)
        .join(offsets, cells)
        .withColumn(name, F.col("_local") + F.col("_offset"))
        .drop("_bucket", "_local", "_offset")
    )


def taken_suffixes(ids: DataFrame, suffix: str, *by: str) -> DataFrame:
    """(base, taken, and the columns ``by``): ids already shaped ``<base><suffix><number>``."""
    pattern = rf"(?s)\A(.*){suffix}({NUMBER})\z"  # ids may hold line breaks
    return (
        ids.filter(F.col("id").rlike(pattern))
        .select(
            F.regexp_extract("id", pattern, 1).alias("base"),
            F.regexp_extract("id", pattern, 2).cast("bigint").alias("taken"),
            *by,
        )
        .distinct()
    )


def ranked_suffixes(taken: DataFrame, *by: str) -> DataFrame:
    return number_rows(taken, ["base", *by], F.shiftright("taken", RANGE_BITS), ["taken"], "place")


def running_before(df: DataFrame, keys: list[str], bucket: str, order: list[str], value: Column, fold, start: Column, name: str) -> DataFrame:
    """``fold`` (a sum or a maximum) of ``value`` over the rows of ``keys`` in front of each row.

    Buckets, which must never decrease along ``order``, are folded by themselves and joined with the fold of those in
    front, so one id with most rows is worked on by many tasks.
    """
    cells = [*keys, bucket]
    front = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    carried = df.groupBy(*cells).agg(fold(value).alias("_own")).select(*cells, fold("_own").over(front).alias("_carried"))
    inside = Window.partitionBy(*cells).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    both = df.withColumn("_inside", fold(value).over(inside)).join(carried, cells)
    folded = F.greatest("_inside", "_carried", start) if fold is F.max else F.coalesce("_inside", start) + F.coalesce("_carried", start)
    return both.withColumn(name, folded).drop("_inside", "_carried")


def repair_duplicates(
    df: DataFrame,
    key: str,
    digest: Column,
    suffix: str = "_dup",
    make_id: Callable[[Column, Column], Column] | None = None,
    bucket_digits: int = 2,
) -> DataFrame:
    """One row per id keeps it (the one with the smallest digest); the n-th repeat gets the n-th free
    ``<id>_dup<number>``, where numbers already used by ids of the batch are not free.

    Ids are counted first, after map-side aggregation, and only rows whose id repeats go on; the others are passed through.
    Repeated ids are staged, so the call runs a job: where they are few, which Spark knows then, no row is shuffled to part the two.
    Rows that are equal in all columns are counted first and written out again after numbering, in runs, so any number of them
    is spread over tasks. Different rows of one id are numbered in ``16 ** bucket_digits`` digest ranges. The numbers
    that a repeat skips are a running maximum over the used numbers in front of it; repeats and used numbers
    are never paired. ``make_id(id, n)`` replaces the naming rule; its ids must be free.
    """
    columns = df.columns
    repeated = df.groupBy(F.col(key).alias("_repeated")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_repeated")
    repeated = staged_alone(repeated, "repeated-ids")
    of_repeated = F.col(key) == F.col("_repeated")
    single, several = (df.join(repeated, of_repeated, how) for how in ("left_anti", "left_semi"))
    groups = several.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")).withColumn("_order", digest)
    groups = groups.withColumn("_bucket", F.substring("_order", 1, bucket_digits))
    zero = F.lit(0).cast("bigint")
    groups = running_before(groups, [key], "_bucket", ["_order"], F.col("_copies"), F.sum, zero, "_before")
    runs = groups.withColumn("_from", F.explode(F.sequence(zero, F.col("_copies") - 1, F.lit(RUN).cast("bigint"))))
    last = F.least(F.col("_from") + RUN, F.col("_copies")) - 1
    rows = runs.withColumn("_nth", F.explode(F.sequence(F.col("_from"), last))).withColumn("_repeat", F.col("_before") + F.col("_nth"))
    rows = rows.select(*columns, "_repeat")
    first, repeats = rows.filter("_repeat = 0").select(*columns), rows.filter("_repeat > 0")
    first = single.select(*columns).unionByName(first)
    if make_id is not None:
        return first.unionByName(repeats.withColumn(key, make_id(F.col(key), F.col("_repeat"))).select(*columns))
    # the number of used suffixes in front of a free one only changes where used numbers leave a hole
    # only ids that hold the suffix are taken apart, and only numbers of repeated ids count
    marked = df.select(F.col(key).alias("id")).filter(F.col("id").contains(suffix))
    taken = taken_suffixes(marked, suffix).join(repeated, F.col("base") == F.col("_repeated"), "left_semi")
    holes = (
        ranked_suffixes(taken)
        .groupBy(F.col("base").alias(key), (F.col("taken") - F.col("place")).alias("_at"))
        .agg(F.max("place").alias("_skipped"))
    )
    # a hole at a gap counts for repeats beyond it
    line = repeats.withColumn("_at", F.col("_repeat") - 1).unionByName(holes, allowMissingColumns=True)
    line = line.withColumn("_bucket", F.shiftright("_at", RANGE_BITS)).withColumn("_is_row", F.col("_repeat").isNotNull())
    line = running_before(line, [key], "_bucket", ["_at", "_is_row"], F.col("_skipped"), F.max, zero, "_jump")
    number = (F.col("_repeat") + F.col("_jump")).cast("string")
    named = line.filter("_is_row").withColumn(key, F.concat(F.col(key), F.lit(suffix), number))
    return first.unionByName(named.select(*columns))


def resolve_conflicts(
    df: DataFrame, key: str, stored: DataFrame, suffix: str = "_new", make_id: Callable[[Column, Column], Column] | None = None
) -> DataFrame:
    """Ids that are already stored become ``<id>_new<number>`` with the first free number.

    Ids of ``df`` must be unique (``repair_duplicates``). ``stored`` has the column ``key``. ``make_id(id, 1)`` replaces the
    naming rule; its ids must be free.
    """
    columns = df.columns
    batch = df.select(F.col(key).alias("id"))
    old = stored.select(F.col(key).cast("string").alias("id"))
    clashing = old.join(batch, "id", "left_semi").distinct().withColumnRenamed("id", "_clash")
    if make_id is not None:
        renamed = F.when(F.col("_clash").isNotNull(), make_id(F.col(key), F.lit(1))).otherwise(F.col(key))
        return df.join(clashing, F.col(key) == F.col("_clash"), "left").withColumn(key, renamed).select(*columns)
    # only ids that hold the suffix are taken apart; a plain substring test is far cheaper than the pattern
    marked = old.unionByName(batch).filter(F.col("id").contains(suffix))
    taken = taken_suffixes(marked, suffix).join(clashing, F.col("base") == F.col("_clash"), "left_semi")
    first_free = (
        ranked_suffixes(taken)
        .groupBy("base")
        .agg((F.count_if(F.col("taken") == F.col("place")) + 1).alias("free"))
    )
    targets = clashing.join(first_free, F.col("_clash") == F.col("base"), "left").select(
        "_clash", F.coalesce("free", F.lit(1)).cast("string").alias("_free")
    )
    fixed = F.when(F.col("_free").isNotNull(), F.concat(F.col(key), F.lit(suffix), "_free")).otherwise(F.col(key))
    return df.join(targets, F.col(key) == F.col("_clash"), "left").withColumn(key, fixed).select(*columns)
