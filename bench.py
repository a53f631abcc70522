"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_RUNS`` (default 2).
Each query runs once to warm up and then ``BENCH_RUNS`` times; the best run counts. Results go to
the no-op sink, so every column of every row is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from logbarge.plans.catalog import QUERIES  # noqa: E402
from logbarge.settings import local_session, own_shared_folder  # noqa: E402

HEADLINE = (
    "shape_records",
    "text_layouts",
    "json_layout",
    "json_typed",
    "quoted_text",
    "record_sizes",
    "batches_by_count",
    "batches_bounded",
    "batches_one_shard",
    "tenant_batches",
    "payload_text",
    "payload_json",
    "payload_proto",
    "payload_snappy",
    "payload_roundtrip",
    "ship_json",
    "ship_proto",
    "delivery_states",
    "thin_drops",
    "select_errors",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = own_shared_folder(local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8))
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    seconds: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - began
            best = took if _ <= 1 else min(best, took)
        seconds[name] = round(best, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "events": events,
        "events_per_sec": {n: round(events / s) for n, s in seconds.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
