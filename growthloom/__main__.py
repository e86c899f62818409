"""Job entry point.

    python -m growthloom build --raw PATH --warehouse PATH [--raw-format parquet]
                               [--tag refresh_daily] [--fact-mode incremental|full|backfill]
                               [--backfill-start-date YYYY-MM-DD] [--week-start sunday|monday]
    python -m growthloom test --warehouse PATH

``build`` rebuilds the models (all, or those carrying ``--tag``) from the raw
event files; ``test`` runs the declared data-quality checks over the tables
found in the warehouse and exits with status 1 if any check fails. The
session comes from the cluster (spark-submit); the jobs read the shared
checkpoint folder from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from growthloom.operators.quality import run_checks
from growthloom.plans.refresh import MODELS, Context, refresh
from growthloom.session import apply_runtime_conf
from growthloom.sources.raw import read_raw_events


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="growthloom")
    sub = p.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="build or refresh the models")
    b.add_argument("--raw", required=True)
    b.add_argument("--raw-format", default="parquet")
    b.add_argument("--warehouse", required=True)
    b.add_argument("--tag", default=None)
    b.add_argument("--fact-mode", default="incremental", choices=["incremental", "full", "backfill"])
    b.add_argument("--backfill-start-date", default=None)
    b.add_argument("--week-start", default="sunday", choices=["sunday", "monday"])
    t = sub.add_parser("test", help="run the data-quality checks over the warehouse")
    t.add_argument("--warehouse", required=True)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"growthloom-{args.command}").getOrCreate()
    apply_runtime_conf(spark)
    if args.command == "build":
        raw = read_raw_events(spark, args.raw, args.raw_format)
        built = refresh(spark, raw, args.warehouse, args.tag, args.fact_mode, args.backfill_start_date, args.week_start)
        print("built:", ", ".join(built))
        return 0
    ctx = Context(spark, spark.createDataFrame([], "x int"), args.warehouse)
    tables = {}
    for m in MODELS:
        if m.materialized == "view":
            continue
        df = m.read(spark, ctx.path(m))
        if df is not None:
            tables[m.name] = df
    if "fct_growth_user_features_daily" in tables and "fct_growth_user_features_weekly" in tables and "fct_growth_user_features_monthly" in tables:
        tables["fct_growth_user_features_combined"] = (
            tables["fct_growth_user_features_daily"]
            .unionByName(tables["fct_growth_user_features_weekly"])
            .unionByName(tables["fct_growth_user_features_monthly"])
        )
    if "fct_cohort_retention_weekly" in tables and "fct_cohort_retention_monthly" in tables:
        tables["fct_cohort_retention_combined"] = tables["fct_cohort_retention_monthly"].unionByName(
            tables["fct_cohort_retention_weekly"]
        )
    summary = run_checks(tables).collect()  # one row per check: a fixed, small report
    failed = [r for r in summary if r.failing_rows > 0]
    for r in summary:
        print(f"{'FAIL' if r.failing_rows else 'PASS'} {r.table_name}.{r.column_name} {r.check_name}: {r.failing_rows}")
    print(f"{len(summary)} checks, {len(failed)} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
