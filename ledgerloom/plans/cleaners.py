"""Raw extract -> clean table and rejected rows, for each of the nine tables."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import cleaning as rules
from ledgerloom.operators.keys import repair_duplicates, resolve_conflicts, row_digest
from ledgerloom.schemas import SPECS, TableSpec
from ledgerloom.session import compiled_methods, staged_alone

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Cleaned:
    rows: DataFrame
    rejected: DataFrame


def dealt(raw: DataFrame) -> DataFrame:
    """Rows of a few large files dealt over all cores, as a file may be one task and the row rules cost far more than a shuffle.

    Rows that come out of a shuffle already are left where they are.
    """
    cores = raw.sparkSession.sparkContext.defaultParallelism
    if len(raw.inputFiles()) >= cores or "Exchange hashpartitioning" in raw._jdf.queryExecution().executedPlan().toString():
        return raw
    return raw.repartition(cores)


def check_rows(raw: DataFrame, spec: TableSpec, references: dict[str, DataFrame], strict: bool = False) -> DataFrame:
    """All row rules of a table, in the table's order; rows keep their first broken rule."""
    unknown = rules.extra_columns(raw, spec.columns)
    if unknown:
        log.warning("%s: dropping unknown columns %s", spec.name, unknown)
    required = spec.strict_required if strict and spec.strict_required else spec.required
    cells = rules.project(raw, spec.columns, required)
    df = rules.project(dealt(raw), spec.columns, required)
    if spec.key:
        df = df.withColumn("_digest", row_digest(spec.columns))
    if spec.times_first:
        df = rules.normalize_times(df, spec.times, spec.required_times)
        df = rules.require(df, required)
    else:
        df = rules.require(df, required)
        df = rules.normalize_times(df, spec.times, spec.required_times)
    df = rules.normalize_dates(df, spec.dates)
    df = rules.normalize_enums(df, spec.enums, spec.nullable_enums)
    for column in spec.booleans:
        df = rules.normalize_boolean(df, column)
    for column in spec.json:
        df = rules.normalize_json(df, column)
    for ref in spec.references:
        nullable = ref.nullable and not strict
        df = rules.require_reference(df, ref.column, references[ref.table], ref.ref_column, nullable, cells)
    # times are parsed by now; what was unreadable but optional stays empty
    must_cast = [c for c in required if c not in spec.times]
    return rules.cast_types(df, spec.types, must_cast)


def emptied(checked: DataFrame, key: str) -> DataFrame:
    """Rejected rows with their key and reason alone, as that is all that is read of them."""
    kept = (key, rules.REJECT)
    return checked.select(*[F.col(c) if c in kept else F.when(rules.good(checked), F.col(c)).alias(c) for c in checked.columns])


def clean_table(
    raw: DataFrame,
    spec: TableSpec,
    references: dict[str, DataFrame] | None = None,
    stored: DataFrame | None = None,
    strict: bool = False,
    resolve: Callable[[DataFrame], DataFrame] | None = None,
) -> Cleaned:
    """One extract, cleaned.

    ``references`` maps table names to the tables that keys point to; ``stored`` is the table's present
    content, for key conflicts; ``resolve`` settles them another way, as by an index. ``strict`` demands every column the original extract check demanded and a
    match for optional keys too. Tables with a key are staged in the shared folder, so the call runs jobs.
    """
    checked = check_rows(raw, spec, references or {}, strict)
    if spec.key:
        # key repair and the rejected rows read this several times
        with compiled_methods(raw.sparkSession):
            checked = staged_alone(emptied(checked, spec.key), f"checked-{spec.name}")
    rows = checked.filter(rules.good(checked)).drop(rules.REJECT)
    if spec.key:
        rows = repair_duplicates(rows, spec.key, F.col("_digest")).drop("_digest")
        if resolve is not None:
            rows = resolve(staged_alone(rows, f"repaired-{spec.name}"))
        elif stored is not None:
            rows = resolve_conflicts(staged_alone(rows, f"repaired-{spec.name}"), spec.key, stored)
    return Cleaned(rows.select(*spec.columns), rules.rejected_rows(checked, spec.name, spec.key))


def clean_named(name: str, raw: DataFrame, **options) -> Cleaned:
    return clean_table(raw, SPECS[name], **options)
