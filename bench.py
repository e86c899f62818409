"""Benchmark the headline queries.

Times a full execution of every query through the ``noop`` sink (everything
is computed, nothing is collected to the driver) and reports the best of
BENCH_REPEAT runs per query: the first run of a plan pays code generation
and JIT warm-up, later runs show the steady-state throughput. Prints one
JSON line.

Local sizing: 2 shuffle partitions per core, and AQE may coalesce small
shuffles down to 256 KB per partition (the default 1 MB leaves the
CPU-heavy aggregates of a few-MB shuffle on a few cores). A cluster sizes
these for its own data.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated subset), BENCH_REPEAT (default 3).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "growth_report",
    "growth_report_orders",
    "growth_report_orders_day",
    "growth_status_day",
    "growth_status_week_orders",
    "growth_status_month",
    "growth_features_day",
    "growth_features_month",
    "features_performance",
    "user_features_month",
    "cohort_month",
    "cohort_combined",
    "event_activity",
    "dim_user_orders",
    "engagement_metrics_month",
    "dq_core",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(HEADLINE)

    from growthloom.session import build_session
    from growthloom.plans.catalog import queries

    spark = build_session(
        f"local[{cpus}]",
        app_name="growthloom-bench",
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus * 2)),
        extra={
            "spark.driver.memory": "16g",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": os.environ.get("BENCH_ADVISORY", "32m"),
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": os.environ.get("BENCH_MIN_PARTITION", "256k"),
        },
    )
    qs = queries()
    # Warm-up: JIT, class loading, file listing caches.
    qs["growth_status_week"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in chosen:
        best = None
        for i in range(repeat):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i == 0:
                first[name] = dt
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "repeat": repeat,
                "first_run_total": round(sum(first.values()), 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
