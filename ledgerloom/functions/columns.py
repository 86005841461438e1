"""Column helpers shared by the cleaners and the models."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Partition column of stored facts: the day of the event.
EVENT_DATE = "event_date"

# Accepted time spellings, the shape that selects each one, in the order they are tried.
TIME_FORMATS = [
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", "yyyy-M-d H:m:s"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}$", "yyyy/M/d H:m"),
    (r"^\d{1,2}-\d{1,2}-\d{4} \d{1,2}:\d{1,2}$", "d-M-yyyy H:m"),
    (r"^\d{14}$", "yyyyMMddHHmmss"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}$", "yyyy-M-d H:m"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}$", "d/M/yyyy H:m"),
    (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$", "yyyy-M-d'T'H:m:s"),
]
# The spellings with separators in one shape, and how its groups make year-month-day time.
SEPARATED = (
    r"\A(?:(\d{4})-(\d{1,2})-(\d{1,2})(?:[ T](\d{1,2}:\d{1,2}:\d{1,2})| (\d{1,2}:\d{1,2}))?"
    r"|(\d{4})/(\d{1,2})/(\d{1,2})(?: (\d{1,2}:\d{1,2}))?"
    r"|(\d{1,2})([-/])(\d{1,2})\11(\d{4}) (\d{1,2}:\d{1,2}))\z"
)
YEAR_FIRST = "$1$6$13-$2$7$12-$3$8$10 $4$5$9$14"
COMPACT = [(shape, pattern) for shape, pattern in TIME_FORMATS if pattern in ("yyyyMMddHHmmss", "yyyyMMdd")]
# Spellings of true and false.
TRUE_WORDS = ["true", "t", "yes", "y", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "0"]


def nonblank(col: Column) -> Column:
    """The trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(col), F.lit(""))


def ratio(num: Column, den: Column) -> Column:
    """Floating quotient, NULL for a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(ratio(num, den), F.lit(0.0))


def zero_if_null(col: Column, like: str = "bigint") -> Column:
    return F.coalesce(col, F.lit(0).cast(like))


def is_true(cond: Column) -> Column:
    """A flag that is never NULL."""
    return F.coalesce(cond, F.lit(False))


def capped_share(value: Column, mean: Column, head_room: float = 1.2) -> Column:
    """value / (head_room * mean), at most 1; NULL stays NULL (``least`` alone would skip it)."""
    share = F.try_divide(value.cast("double"), F.nullif(mean * F.lit(head_room), F.lit(0.0)))
    return F.when(share.isNotNull(), F.least(share, F.lit(1.0)))


def exact_mean(col: Column, kind: str) -> Column:
    """Mean over fixed-point values: the sum does not depend on the order in which tasks finish, so
    thresholds on the mean fall the same way in every run."""
    return F.sum(col.cast(kind)).cast("double") / F.nullif(F.count(col), F.lit(0))


def growth_percent(now: Column, before: Column) -> Column:
    return ratio(now - before, before) * F.lit(100.0)


def whole_hours(start: Column, end: Column) -> Column:
    return F.timestamp_diff("HOUR", start, end)


def within_days(ts: Column, start: date | None, end: date | None) -> Column:
    """start <= day(ts) <= end as a half-open range on the bare column, so files can be pruned."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (ts >= F.lit(start).cast("timestamp"))
    if end is not None:
        cond = cond & (ts < F.lit(end + timedelta(days=1)).cast("timestamp"))
    return cond


def between_days(df: DataFrame, ts: str, start: date | None, end: date | None) -> DataFrame:
    """Rows of the days from ``start`` to ``end``; tables stored by event date read only those folders."""
    rows = df.filter(within_days(F.col(ts), start, end))
    if EVENT_DATE in df.columns:
        if start is not None:
            rows = rows.filter(F.col(EVENT_DATE) >= F.lit(start))
        if end is not None:
            rows = rows.filter(F.col(EVENT_DATE) <= F.lit(end))
    return rows


def month_label(ts: Column) -> Column:
    """The report month a moment is counted in: the first day of the following month."""
    return F.add_months(F.trunc(ts, "month"), 1)


def parse_timestamp(text: Column) -> Column:
    """First accepted spelling that fits (``TIME_FORMATS``); NULL for anything else.

    A parser and a shape test for each spelling cost most of the time of the row rules. Spellings with separators are brought into
    the one form that a cast reads, by one replacement; only compact ones need a parser.
    """
    cell = F.trim(text)
    written = F.regexp_replace(cell, SEPARATED, YEAR_FIRST).try_cast("timestamp")
    parsed = F.when(cell.rlike(SEPARATED), written)
    for shape, pattern in COMPACT:
        parsed = parsed.when(cell.rlike(shape), F.try_to_timestamp(cell, F.lit(pattern)))
    return parsed


def parse_boolean(text: Column, default: bool = False) -> Column:
    """0/1 from the usual spellings and from numbers; the default for anything else."""
    word = F.lower(F.trim(text))
    number = word.try_cast("double")
    return (
        F.when(word.isin(TRUE_WORDS), F.lit(1))
        .when(word.isin(FALSE_WORDS), F.lit(0))
        .when(number.isNotNull(), (number != 0).cast("int"))
        .otherwise(F.lit(int(default)))
    )


def declared_spelling(text: Column, allowed: Sequence[str]) -> Column:
    """Match ignoring case and outer blanks; give back the declared spelling, NULL if not allowed."""
    table = F.create_map(*[F.lit(x) for value in allowed for x in (value.lower(), value)])
    return F.try_element_at(table, F.lower(F.trim(text)))


def json_text(text: Column) -> Column:
    """Valid JSON in compact form; text that does not parse becomes a JSON string."""
    parsed = F.try_parse_json(text)
    quoted = F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r'^\{"v":(.*)\}$', 1)
    return F.when(parsed.isNotNull(), F.to_json(parsed)).when(text.isNotNull(), quoted)


def rename_json_key(text: Column, old: str, new: str) -> Column:
    """Rename a key at every depth of a JSON text; string values are left alone. Keys may hold any characters."""
    written = re.escape(json.dumps(old, ensure_ascii=False))
    renamed = json.dumps(new, ensure_ascii=False).replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(text, F.lit(rf"(?<!\\){written}(\s*):"), F.lit(f"{renamed}$1:"))


def json_object(entries: Column) -> Column:
    """One JSON object from an array of (key, value) structs, keys in order, NULL members kept."""
    return F.to_json(F.map_from_entries(F.array_sort(entries)), {"ignoreNullFields": "false"})


def ordered_text(entries: Column, field: str) -> Column:
    """Comma list of one field of an array of structs, in struct order, NULLs left out."""
    return F.array_join(F.transform(F.array_sort(entries), lambda e: e[field]), ",")
