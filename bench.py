"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and runs on ``local[BENCH_CPUS]``.
Each query runs once to warm up, then ``BENCH_RUNS`` times (default 3); its time is the
median. Every row is computed and handed to a sink that discards it.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from smeltwork.queries import ALL  # noqa: E402
from smeltwork.session import local_session  # noqa: E402

HEADLINE = [
    "string_safe_cast_lines",
    "ingest_csv",
    "ingest_parquet",
    "ingest_mixed_formats",
    "route_files",
    "dedup_latest",
    "dedup_composite",
    "dedup_skewed_key",
    "dedup_exact",
    "cleanse_latest_then_rule",
    "quarantine_counts",
    "row_hash",
    "sk_sequence_composite",
    "scd_initial_load_orders",
    "scd1_merge_orders",
    "scd2_merge",
    "scd2_merge_orders",
    "scd2_from_history",
    "scd2_from_history_orders",
    "layers_end_to_end",
    "stream_ingest",
]


def timed(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    ALL[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    partitions = int(cpus) if cpus.isdigit() else 8
    memory = os.environ.get("BENCH_MEMORY", "8g")
    settings = {"spark.driver.memory": memory, "spark.ui.showConsoleProgress": "false"}
    spark = local_session(cpus, partitions, **settings)
    seconds = {}
    for name in names:
        timed(spark, sf_dir, name)
        seconds[name] = round(statistics.median(timed(spark, sf_dir, name) for _ in range(runs)), 3)
    factor = re.search(r"sf([0-9.]+)$", sf_dir)
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(factor.group(1)) if factor else sf_dir,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
