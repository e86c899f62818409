"""Stage times of one registered query, from Spark's event log.

Usage: python tests/stage_times.py QUERY [sf_dir]
Runs the query twice through the ``noop`` sink with the event log written to
a new scratch folder and prints the stages of the second (warm) run: wall
time, tasks, executor run time and shuffle records written / read.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def _events(log_dir: str):
    import zstandard

    app = sorted(glob.glob(f"{log_dir}/*"), key=os.path.getmtime)[-1]
    for f in sorted(glob.glob(f"{app}/*")):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8", "replace").splitlines():
            try:
                yield json.loads(line)
            except ValueError:
                continue


def main(argv) -> None:
    name = argv[1]
    sf_dir = argv[2] if len(argv) > 2 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="growthloom-eventlog-")
    from growthloom.plans.catalog import queries
    from growthloom.session import build_session

    spark = build_session(
        "local[8]",
        shuffle_partitions=16,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
        },
    )
    runs = []
    for _ in range(2):
        t0 = time.perf_counter()
        queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        runs.append(time.perf_counter() - t0)
    spark.stop()

    stages = {}
    for e in _events(log_dir):
        if e.get("Event") == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            acc = {a["Name"]: a.get("Value") for a in si.get("Accumulables", [])}
            stages[si["Stage ID"]] = (
                si.get("Completion Time", 0) - si.get("Submission Time", 0),
                si["Number of Tasks"],
                acc.get("internal.metrics.executorRunTime"),
                acc.get("internal.metrics.shuffle.write.recordsWritten"),
                acc.get("internal.metrics.shuffle.read.recordsRead"),
            )
    ids = sorted(stages)
    warm = ids[len(ids) // 2:]
    print(f"{name}: runs {[round(r, 2) for r in runs]} s; warm run: {len(warm)} stages, "
          f"{sum(stages[i][0] for i in warm)} ms of stage wall time")
    print("stage  wall_ms  tasks  run_ms  shuffle_write  shuffle_read")
    for i in warm:
        w, n, r, sw, sr = stages[i]
        print(f"{i:5d} {w:8d} {n:6d} {r or 0:7d} {sw or 0:14d} {sr or 0:13d}")


if __name__ == "__main__":
    main(sys.argv)
