"""Row rules that turn raw text rows into typed ones.

A rule never drops a row at once: it marks the row with the first rule it breaks and leaves it in place.
``split`` then gives the clean rows and the rejected ones with their reason, so nothing gets lost and all
rules of a table run in one pass over the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import (
    declared_spelling,
    json_text,
    nonblank,
    parse_boolean,
    parse_timestamp,
    rename_json_key,
)
from ledgerloom.session import broadcastable, staged_alone

REJECT = "_reject"
REJECT_TYPE = "struct<rule:string,column_name:string,value:string>"
# Blank keys are spread over this many never-matching join keys instead of meeting in one task.
BLANK_SPREAD = 4096


class MissingColumns(ValueError):
    """The extract lacks a required column."""


class EmptyResult(RuntimeError):
    """A job has nothing left to write."""


def extra_columns(df: DataFrame, allowed: list[str]) -> list[str]:
    """Columns of the extract that the table does not know; reported, not an error."""
    known = set(allowed)
    return [c for c in df.columns if c not in known]


def project(df: DataFrame, columns: list[str], required: list[str]) -> DataFrame:
    """Keep the table's columns as trimmed text, blank as NULL; absent optional columns become NULL."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumns(f"required columns missing: {missing}")
    present = set(df.columns)
    return df.select(
        *[
            (nonblank(F.col(c).cast("string")) if c in present else F.lit(None).cast("string")).alias(c)
            for c in columns
        ],
        F.lit(None).cast(REJECT_TYPE).alias(REJECT),
    )


def mark(df: DataFrame, bad: Column, rule: str, column: str, value: Column | None = None) -> DataFrame:
    """Note the rule on rows that break it and have broken none before."""
    found = F.struct(
        F.lit(rule).alias("rule"),
        F.lit(column).alias("column_name"),
        (F.col(column) if value is None else value).cast("string").alias("value"),
    )
    return df.withColumn(REJECT, F.coalesce(F.col(REJECT), F.when(bad, found)))


def evaluate(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add computed columns as a step of their own.

    The optimizer copies a column's expression into every filter and rule above it. A cell parsed by ten
    patterns and read by several rules would grow into code too large to compile; a generated row stops that.
    """
    return df.select("*", F.inline(F.array(F.struct(*[e.alias(name) for name, e in columns.items()]))))


def _replace(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(f"_new_{c}") for c in columns}).drop(*[f"_new_{c}" for c in columns])


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    for c in columns:
        df = mark(df, F.col(c).isNull(), "not_null", c)
    return df


def normalize_times(df: DataFrame, columns: list[str], required: list[str] = ()) -> DataFrame:
    """Parse the accepted spellings; unreadable cells become NULL, or reject the row where required."""
    if not columns:
        return df
    df = evaluate(df, {f"_new_{c}": parse_timestamp(F.col(c)) for c in columns})
    for c in required:
        df = mark(df, F.col(f"_new_{c}").isNull(), "timestamp", c)
    return _replace(df, columns)


def normalize_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    if not columns:
        return df
    df = evaluate(df, {f"_new_{c}": F.to_date(parse_timestamp(F.col(c))) for c in columns})
    for c in columns:
        df = mark(df, F.col(f"_new_{c}").isNull(), "date", c)
    return _replace(df, columns)


def normalize_enums(df: DataFrame, enums: dict[str, list[str]], nullable: frozenset[str] = frozenset()) -> DataFrame:
    """Give values their declared spelling; reject others, and NULL unless allowed."""
    if not enums:
        return df
    df = evaluate(df, {f"_new_{c}": declared_spelling(F.col(c), allowed) for c, allowed in enums.items()})
    for c in enums:
        bad = F.col(f"_new_{c}").isNull()
        if c in nullable:
            bad = bad & F.col(c).isNotNull()
        df = mark(df, bad, "enum", c)
    return _replace(df, list(enums))


def normalize_boolean(df: DataFrame, column: str, default: bool = False) -> DataFrame:
    return df.withColumn(column, parse_boolean(F.col(column), default))


def normalize_json(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, json_text(F.col(column)))


def rename_column(df: DataFrame, old: str, new: str, json_columns: list[str] = ()) -> DataFrame:
    """Rename a column, and the same key inside the named JSON columns at every depth."""
    df = df.withColumnRenamed(old, new)
    for c in json_columns:
        df = df.withColumn(c, rename_json_key(F.col(c), old, new))
    return df


def join_key(df: DataFrame, column: str) -> Column:
    """The trimmed key; rows without one get scattered keys that match nothing."""
    row = F.xxhash64(*[F.col(c) for c in df.columns if c != REJECT])
    scattered = F.concat(F.lit("\u0000"), F.pmod(row, F.lit(BLANK_SPREAD)).cast("string"))
    return F.coalesce(F.trim(F.col(column).cast("string")), scattered)


def require_reference(
    df: DataFrame, column: str, reference: DataFrame, ref_column: str, nullable: bool = False, cells: DataFrame | None = None
) -> DataFrame:
    """Reject rows whose key is not in the reference table; ``nullable`` lets blank keys pass.

    The join carries no hint: Spark broadcasts a small key list and otherwise merges, splitting hot keys
    of the left side at run time.

    ``cells`` has the same cells of ``column`` where they are cheaper to read than from ``df``, such as the rows ahead of other
    rules. A key list too large to broadcast then meets the distinct keys of the column alone, and rows are looked up among
    the unknown keys. Those are staged, so the call runs a job: where they are few, which Spark knows then, no row is shuffled.
    """
    known = (
        reference.select(F.trim(F.col(ref_column).cast("string")).alias("_known"))
        .filter(F.col("_known").isNotNull())
        .distinct()
    )
    if cells is not None and not broadcastable(known):
        keys = cells.select(F.trim(F.col(column).cast("string")).alias("_unknown")).filter(F.col("_unknown").isNotNull()).distinct()
        unknown = staged_alone(keys.join(known, F.col("_unknown") == F.col("_known"), "left_anti"), f"unknown-{column}")
        joined = df.withColumn("_probe", join_key(df, column)).join(unknown, F.col("_probe") == F.col("_unknown"), "left")
        bad = F.col("_unknown").isNotNull()
        if not nullable:
            bad = bad | F.col(column).isNull()
        return mark(joined, bad, "foreign_key", column).drop("_probe", "_unknown")
    joined = df.withColumn("_probe", join_key(df, column)).join(known, F.col("_probe") == F.col("_known"), "left")
    bad = F.col("_known").isNull()
    if nullable:
        bad = bad & F.col(column).isNotNull()
    return mark(joined, bad, "foreign_key", column).drop("_probe", "_known")


def cast_types(df: DataFrame, types: dict[str, str], required: list[str]) -> DataFrame:
    """Cast to the table's types; a failed cast empties the cell, or rejects the row where required."""
    open_casts = {c: kind for c, kind in types.items() if df.schema[c].dataType.simpleString() != kind}
    if not open_casts:
        return df
    df = evaluate(df, {f"_new_{c}": F.col(c).try_cast(kind) for c, kind in open_casts.items()})
    for c in open_casts:
        if c in required:
            df = mark(df, F.col(f"_new_{c}").isNull(), "type", c)
    return _replace(df, list(open_casts))


def good(df: DataFrame) -> Column:
    return F.col(REJECT).isNull()


def rejected_rows(df: DataFrame, table: str, key: str | None) -> DataFrame:
    """Why rows were dropped: table, key, rule, column and offending value."""
    return df.filter(F.col(REJECT).isNotNull()).select(
        F.lit(table).alias("table_name"),
        (F.col(key) if key else F.lit(None)).cast("string").alias("row_key"),
        f"{REJECT}.rule",
        f"{REJECT}.column_name",
        f"{REJECT}.value",
    )


def ensure_not_empty(df: DataFrame, what: str) -> DataFrame:
    """Stop the job when nothing is left to write; used once, where a job ends."""
    if df.isEmpty():
        raise EmptyResult(f"no rows left for {what}")
    return df
