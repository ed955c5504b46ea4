"""Times the headline queries and prints one JSON line.

Each query is planned and run in full (no-op sink) twice; the faster run counts.
BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma-separated keys or "all") choose what runs.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from harness.check import session  # noqa: E402
from harness.registry import QUERIES  # noqa: E402

HEADLINE = [
    *(k for k in QUERIES if k.startswith("ind_")),
    "layout_complete",
    "count_per_area",
    "dim_build",
    "full_then_group",
    "group_year_dept_key",
    "national_associations",
    "prefix_name_match",
    "fill_first_match",
    "located_media",
    "latest_snapshot",
    "header_detect",
    "row_dedupe",
    "rounded_values",
    "code_repair",
    "csv_round_trip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES")
    keys = HEADLINE if not chosen else list(QUERIES) if chosen == "all" else chosen.split(",")
    spark = session(int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8)))
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["layout_complete"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for key in keys:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[key] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
