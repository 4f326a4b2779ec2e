"""Benchmark the headline queries.

Runs each query once to warm up, then ``BENCH_RUNS`` times (default 3), executing the
full plan with the ``noop`` sink (no collect to the driver), and prints one JSON line:

    {"metric": "total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_RUNS`` (default 3), ``BENCH_QUERIES`` (comma list, default the headline set).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridmart.plans.registry import queries  # noqa: E402
from gridmart.session import get_session  # noqa: E402

HEADLINE = [
    "mart_points_allowed", "mart_player_week", "mart_util_receiving", "mart_util_rushing",
    "tier_shares", "lag_gap_capped", "asof_nearest", "best_lineup", "dedupe_first",
    "agg_basic", "join_full_reconcile", "effect_ci", "promote_incremental", "rules_scoring",
    "mart_util_all", "mart_util_wr", "league_by_week",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_session(f"local[{cpus}]", app="gridmart-bench", shuffle_partitions=cpus * 2,
                        extra={"spark.driver.memory": "16g"})
    qs = queries()
    timings: dict[str, float] = {}
    for name in names:
        def run() -> float:
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        run()  # warm-up: JIT, file listing, Parquet footers
        timings[name] = round(statistics.median(run() for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({"metric": "total_median_sec", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
