"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Each query runs once to warm
up and is then timed with its whole result produced and discarded.
"""

import json
import os
import time

from navlake.plans.queries import QUERIES
from navlake.session import local_session

HEADLINE = [
    "dedupe_nav", "label_nav", "latest_nav", "category_summary", "fund_house_summary",
    "recent_navs", "nav_asof_backward", "nav_asof_join_backward",
    "returns_1y_asof", "returns_1y_last_nav", "returns_grid_asof", "returns_grid_last_nav",
    "category_returns", "category_returns_summary",
    "coverage_report", "freshness_report", "chunk_coverage", "duplicate_stats",
    "upsert_scheme_master", "resolve_company",
    "parse_daily_feed", "parse_labelled_feed", "merge_nav_history", "daily_update",
    "returns_from_lake", "returns_over_loads", "compact_nav_history",
    "ingest_stream_daily", "rebuild_nav_history", "read_raw_nav",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus, partitions=int(cpus) if cpus.isdigit() else 8)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(run(name), 3)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
