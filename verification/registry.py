"""All registered queries and their SQL, by name."""

from __future__ import annotations

from verification import cleaning_queries, late_queries, lifetime_queries, model_queries, primitive_queries, storage_queries

MODULES = [model_queries, lifetime_queries, late_queries, cleaning_queries, storage_queries, primitive_queries]

QUERIES: dict = {}
ORACLES: dict = {}
for module in MODULES:
    clash = QUERIES.keys() & module.QUERIES.keys()
    if clash:
        raise ValueError(f"registered twice: {sorted(clash)}")
    QUERIES |= module.QUERIES
    ORACLES |= module.ORACLES


def _in_utc(build):
    """Run a query with the time zone its tables are written in."""

    def run(spark, sf_dir):
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(spark, sf_dir)

    return run


QUERIES = {name: _in_utc(build) for name, build in QUERIES.items()}
