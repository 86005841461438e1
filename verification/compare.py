"""Run registered queries against DuckDB: python -m verification.compare [sf] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Rows as text in a fixed order, so engines can be compared cell by cell."""

    def cell(value):
        if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
            return "NULL"
        if isinstance(value, bool) or type(value).__name__ == "bool_":
            return str(bool(value))
        if isinstance(value, (int, float)) or hasattr(value, "dtype"):
            number = float(value)
            return repr(0.0 if number == 0 else number)
        if isinstance(value, pd.Timestamp) or hasattr(value, "isoformat"):
            stamp = pd.Timestamp(value)
            return stamp.isoformat()
        return str(value)

    columns = sorted(df.columns)
    out = pd.DataFrame({c: [cell(v) for v in df[c].tolist()] for c in columns}, columns=columns)
    return out.sort_values(columns).reset_index(drop=True)


def difference(spark_df: pd.DataFrame, duck_df: pd.DataFrame) -> str | None:
    """None when equal, else a short report."""
    if sorted(spark_df.columns) != sorted(duck_df.columns):
        return f"columns {sorted(set(spark_df.columns) ^ set(duck_df.columns))}"
    if len(spark_df) != len(duck_df):
        return f"rows {len(spark_df)} vs {len(duck_df)}"
    a, b = canonical(spark_df), canonical(duck_df)
    if a.equals(b):
        return None
    unequal = (a != b).any(axis=1)
    per_column = {c: int((a[c] != b[c]).sum()) for c in a.columns if (a[c] != b[c]).any()}
    first = unequal.idxmax()
    return f"{int(unequal.sum())} rows differ, by column {per_column}\n  spark {a.loc[first].to_dict()}\n  duck  {b.loc[first].to_dict()}"


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from ledgerloom.session import build_session
    from verification import registry

    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        "compare",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, build in registry.QUERIES.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            mine = build(spark, sf_dir).toPandas()
            took = time.time() - start
            if name not in registry.ORACLES:
                print(f"rows  {name}: {len(mine)} in {took:.1f}s", flush=True)
                continue
            start = time.time()
            theirs = con.execute(registry.ORACLES[name]).df()
            problem = difference(mine, theirs)
            duck = time.time() - start
        except Exception as error:  # report and go on with the next query
            problem, took, duck = f"{type(error).__name__}: {str(error)[:1500]}", time.time() - start, 0
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name}: {took:.1f}s, duckdb+compare {duck:.1f}s {problem or len(mine)}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    raise SystemExit(1 if main() else 0)
