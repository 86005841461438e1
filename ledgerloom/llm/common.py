"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: ASCII white space, as a set for trim() and as a regular expression class. Fixed values.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def id_crc(column: str = "doc_id") -> Column:
    """crc32 of an id written as decimal text; NULL stays NULL."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def in_remainder(column: str, divisor: int, remainder: int) -> Column:
    """Whether crc32(id as text) mod divisor is the remainder; a missing id counts as outside."""
    return F.coalesce(id_crc(column) % divisor == remainder, F.lit(False))


def seeded_digest(column: str, seed: int, text: str) -> Column:
    """32 hexadecimal digits that shuffle rows by their id and text, the same on every run and engine.

    With the text in it, an id that many rows share or lack is spread over all digests.
    """
    doc = F.coalesce(F.col(column).cast("string"), F.lit("null"))
    return F.md5(F.concat(F.lit(f"{seed}:"), doc, F.lit(":"), F.md5(text_or_empty(text).cast("binary"))))


def digest_bucket(digest: Column, buckets: int) -> Column:
    """Equal ranges of the first 32 bits of a digest, in the digest's own order. buckets: a power of two."""
    head = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.shiftright(head, 32 - (buckets.bit_length() - 1)).cast("int")


def bucket_count(rows: int, rows_each: int = 20_000, least: int = 1024) -> int:
    """How many order-preserving buckets a distributed ranking uses: a power of two that grows with the rows."""
    wanted = max(least, -(-rows // rows_each))
    return 1 << (wanted - 1).bit_length()


def with_running_totals(df: DataFrame, groups: list[str], bucket: str, order: list[str], totals: dict[str, Column]) -> DataFrame:
    """Running totals before each row, over rows of a group in the given order, without one task per group.

    bucket must follow the order (a later bucket holds later rows). Each (group, bucket) is summed by
    itself and then shifted by the sums of the buckets before it, so a group that holds a third of all rows
    is worked on by as many tasks as it has buckets. totals maps a new column to the summed expression; the
    new column has the total of the rows before (ties are broken by Spark's own order of equal rows).
    df is evaluated twice: it must be deterministic; groups must not be NULL. The sums are never broadcast: Spark takes
    what comes out of explode() for as small as what went in.
    """
    keys = [*groups, bucket]
    sums = df.groupBy(*keys).agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in totals.items()])
    earlier = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_shift_{n}") for n in totals],
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumns({f"_local_{n}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in totals.items()})
    same = [F.col(k) == F.col(f"_key_{k}") for k in keys]
    return local.join(shifts.hint("merge"), same).select(
        *df.columns, *[(F.col(f"_local_{n}") + F.col(f"_shift_{n}")).alias(n) for n in totals]
    )
