"""Times the headline queries; prints one JSON line.

Each query is run once to warm up and then timed; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tideline.catalog import QUERIES  # noqa: E402
from tideline.session import local_session  # noqa: E402

HEADLINE = (
    "entry_bounded_pull",
    "bounded_pull_backlog",
    "batch_assign",
    "key_composite",
    "record_json",
    "message_envelope",
    "fold_patches",
    "fold_named_fields",
    "merge_patches",
    "apply_log",
    "histogram_cumulative",
    "pull_once",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus)
    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(taken[1:]), 4)
    line = {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
