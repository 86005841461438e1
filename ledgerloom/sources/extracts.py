"""Raw daily extracts: ``<root>/ods_<table>/<date>/*.csv`` with a header row, every cell text."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def extract_path(root: str, table: str, day: date) -> str:
    return f"{root.rstrip('/')}/ods_{table}/{day.isoformat()}"


def read_extract(
    spark: SparkSession, root: str, table: str, day: date, columns: list[str] | None = None, multi_line: bool = True
) -> DataFrame:
    """One table's extract of one day; only its own folder is listed.

    ``columns`` is the header, for extracts whose header is known; otherwise it is taken from the file.
    Types are never inferred: one dirty cell would change a column's type from day to day. Cells may hold line breaks, so a
    file is read by one task; ``multi_line=False`` splits large files whose cells are known to hold none.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').option("emptyValue", "")
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
        reader = reader.option("enforceSchema", False)
    return reader.csv(extract_path(root, table, day))


def write_extract(df: DataFrame, root: str, table: str, day: date) -> str:
    path = extract_path(root, table, day)
    text = df.select(*[df[c].cast("string").alias(c) for c in df.columns])
    writer = text.write.mode("overwrite").option("header", True).option("escape", '"')
    # outer blanks are part of the raw cell
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path
