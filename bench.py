"""Time the headline queries: one warm-up run, then the best of two, each in full."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stormspan.catalog import QUERIES  # noqa: E402
from stormspan.session import local_session  # noqa: E402

HEADLINE = (
    "band_counts",
    "hourly_max",
    "rolling_partial",
    "unique_storms",
    "storms_per_duration",
    "lookback_storm",
    "rain_events",
    "prior_rain",
    "rain_gaps",
    "unify_feeds",
    "outfall_totals",
    "overlap_counts",
    "ratio_topk",
    "year_grid",
    "describe",
    "correlations",
    "parse_ranges",
    "clean_strict",
    "html_rows",
    "gates_to_points",
    "grid_pivot",
    "zone_means",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        took = []
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        seconds[name] = round(min(took[1:]), 3)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
