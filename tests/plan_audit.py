"""Physical-plan audit of every registered query.

Usage: python tests/plan_audit.py [sf_dir]
Prints, per query: shuffles, sort-merge / broadcast hash joins, aggregate
kinds, windows, generators, and any forbidden operator (cartesian product,
nested-loop join, Python evaluation).
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def audit(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    count = lambda pat: len(re.findall(pat, plan))
    return {
        "exchanges": count(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin"),
        "single_partition": count(r"Exchange SinglePartition"),
        "smj": count(r"SortMergeJoin"),
        "bhj": count(r"BroadcastHashJoin"),
        "hash_agg": count(r"\bHashAggregate"),
        "object_agg": count(r"ObjectHashAggregate"),
        "sort_agg": count(r"SortAggregate"),
        "windows": count(r"\bWindow \["),
        "generate": count(r"\bGenerate "),
        "forbidden": [f for f in FORBIDDEN if f in plan],
    }


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    import __spark_entry__ as E
    from growthloom.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    print(f"{'query':30s} exch 1part smj bhj hash obj sort win gen forbidden")
    for name, fn in E.queries().items():
        a = audit(fn(spark, sf_dir))
        print(
            f"{name:30s} {a['exchanges']:4d} {a['single_partition']:5d} {a['smj']:3d} {a['bhj']:3d} "
            f"{a['hash_agg']:4d} {a['object_agg']:3d} {a['sort_agg']:4d} {a['windows']:3d} {a['generate']:3d} {a['forbidden']}"
        )


if __name__ == "__main__":
    main(sys.argv)
