"""Output form shared with the SQL checks: decimals and doubles as 6-digit doubles.

Counters that can be empty are doubles as well, so an empty cell looks the same from both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULLABLE_COUNTERS = {"active_users", "new_users", "total_new_user", "total_returns", "total_orders", "base_order_cnt"}


def plain(df: DataFrame) -> DataFrame:
    def column(field: T.StructField):
        if isinstance(field.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            return F.round(F.col(field.name).cast("double"), 6).alias(field.name)
        if field.name in NULLABLE_COUNTERS:
            return F.col(field.name).cast("double").alias(field.name)
        return F.col(field.name)

    return df.select(*[column(f) for f in df.schema.fields])
