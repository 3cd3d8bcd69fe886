"""Bench of the headline queries.

Prints one JSON line.  Every query runs once to warm up (which also lands its
export), then BENCH_RUNS times; the median counts.  Results go to a sink that
reads every row and column and keeps nothing.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import QUERIES  # noqa: E402
from orderloom.session import clear_scratch, local_session  # noqa: E402

HEADLINE = [
    "order_line_items",
    "normalise_orders",
    "entity_split",
    "upsert_incremental",
    "upsert_partitioned",
    "stream_landing",
    "csv_roundtrip",
    "csv_roundtrip_exact",
    "scan_bulk_jsonl",
    "orders_dataset",
    "custom_dataset",
    "run_selected",
    "parent_child_join",
    "location_with_levels",
    "parent_occurrence",
    "entity_keys",
    "products_dataset",
    "run_paged",
    "load_incremental",
]


def run(spark, sf_dir: str, name: str) -> float:
    started = time.monotonic()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.monotonic() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    scratch = tempfile.mkdtemp(prefix="orderloom-bench-")
    spark = local_session(scratch, cores, memory=os.environ.get("BENCH_MEMORY", "8g"))
    seconds = {}
    for name in names:
        run(spark, sf_dir, name)
        seconds[name] = round(statistics.median(run(spark, sf_dir, name) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    clear_scratch(spark)
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
        "cores": cores,
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
