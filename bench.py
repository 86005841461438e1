"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores.
Every query runs to its last row (``noop`` sink); plan building is part of the time.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerloom.session import build_session  # noqa: E402
from verification.registry import QUERIES  # noqa: E402

HEADLINE = [
    "dws_daily_sales",
    "dws_merchant_daily",
    "dws_merchant_profile",
    "dws_product_summary",
    "dws_user_profile",
    "dws_business_daily_health",
    "ads_merchant_monthly_snapshot",
    "ads_user_monthly_snapshot",
    "ads_platform_monthly_summary",
    "ads_platform_promotion_detail",
    "ads_user_yearly_snapshot",
    "ads_platform_yearly_summary",
    "clean_user_actions",
    "clean_orders",
    "repair_duplicate_keys",
    "quality_alerts",
    "report_links_new_year",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["select_distinct"](spark, sf_dir).count()  # start the executors
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    sf = Path(sf_dir).name.removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
