"""Headline queries, timed: prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.  A query's
time is the fastest of ``BENCH_REPEATS`` runs into the ``noop`` sink, after one
untimed warm-up of the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallymart.registry import REGISTRY  # noqa: E402
from tallymart.session import build_session  # noqa: E402

HEADLINE = (
    "monthly_revenue",
    "monthly_revenue_by_category",
    "monthly_revenue_by_country",
    "top_customers",
    "category_share",
    "pareto_latest",
    "category_pivot_top8",
    "gap_filled_by_category",
    "mom_yoy_ytd",
    "rolling_band_by_category",
    "insights",
    "dashboard_series",
    "clean_money",
    "good_rows",
    "quality_metrics",
    "except_all",
    "null_rates",
    "dedupe_latest",
    "customer_ltv",
    "customer_churn",
    "customer_retention",
    "silver_roundtrip",
    "batch_pipeline_gold",
    "incremental_ingest",
    "daily_revenue_stream",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run(HEADLINE[0])
    names = sys.argv[1:] or HEADLINE
    seconds = {name: round(min(run(name) for _ in range(repeats)), 3) for name in names}
    report = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(os.path.normpath(sf_dir)),
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
