"""Report links: one URL per report, entity and day."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Report:
    name: str
    dashboard: int
    frequency: str
    entity: str


# The eight reports.
REPORTS = [
    Report("user_monthly", 2, "monthly", "user"),
    Report("user_yearly", 3, "yearly", "user"),
    Report("merchant_daily", 4, "daily", "merchant"),
    Report("merchant_monthly", 5, "monthly", "merchant"),
    Report("merchant_yearly", 6, "yearly", "merchant"),
    Report("platform_daily", 7, "daily", "platform"),
    Report("platform_monthly", 8, "monthly", "platform"),
    Report("platform_yearly", 9, "yearly", "platform"),
]
LINK_KEYS = ["create_date", "report", "entity_id"]


def due(frequency: str, day: date) -> bool:
    """Daily reports always, monthly on day 1, yearly on January 1."""
    return {"daily": True, "monthly": day.day == 1, "yearly": (day.month, day.day) == (1, 1)}.get(frequency, False)


def due_reports(day: date, reports: list[Report] = REPORTS) -> list[Report]:
    return [r for r in reports if due(r.frequency, day)]


def report_links(
    users: DataFrame,
    merchants: DataFrame,
    day: date,
    base_url: str,
    public_ids: dict[int, str],
    reports: list[Report] = REPORTS,
) -> DataFrame:
    """Links of the reports due on ``day``: (report, entity_id, create_date, link).

    Each entity row is repeated once per due report. Reports without a public id are left out. Yearly
    user and merchant links name the year only; platform links have one row and always the full date.
    """
    spark = users.sparkSession
    entities = {
        "user": users.select(F.col("user_id").alias("entity_id")),
        "merchant": merchants.select(F.col("merchant_id").alias("entity_id")),
        "platform": spark.range(1).select(F.lit(None).cast("string").alias("entity_id")),
    }
    parts = []
    for kind, ids in entities.items():
        wanted = [r for r in due_reports(day, reports) if r.entity == kind and r.dashboard in public_ids]
        if not wanted:
            continue
        specs = F.array(
            *[
                F.struct(
                    F.lit(r.name).alias("report"),
                    F.lit(f"{base_url}/public/dashboard/{public_ids[r.dashboard]}").alias("page"),
                    F.lit(
                        str(day.year) if r.frequency == "yearly" and kind != "platform" else day.isoformat()
                    ).alias("period"),
                )
                for r in wanted
            ]
        )
        id_part = F.lit("") if kind == "platform" else F.concat(F.lit("id="), "entity_id", F.lit("&"))
        parts.append(
            ids.select("entity_id", F.inline(specs)).select(
                "report",
                "entity_id",
                F.lit(day).alias("create_date"),
                F.concat("page", F.lit("?"), id_part, F.lit("date="), "period").alias("link"),
            )
        )
    if not parts:
        return spark.createDataFrame([], "report STRING, entity_id STRING, create_date DATE, link STRING")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
