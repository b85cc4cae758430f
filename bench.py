"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from panelcast.queries import QUERIES
from tests.session import local_session

HEADLINE = [
    "ohlcv_daily",
    "macro_asof",
    "combined_panel",
    "supplier_bars",
    "supplier_combined_panel",
    "supplier_seasonal_decompose",
    "supplier_feature_frame",
    "supplier_f_scores",
    "supplier_scale_standard",
    "supplier_grid_leaderboard",
    "supplier_forecast_metrics",
]


def run(name: str, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, partitions=2 * cpus)
    names = sys.argv[1:] or HEADLINE
    run("ohlcv_daily", spark, sf_dir)  # starts the executors
    times = {name: round(run(name, spark, sf_dir), 3) for name in names}
    sf = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
