"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickloom import catalog  # noqa: E402
from tickloom.session import local_session  # noqa: E402

HEADLINE = [
    "daily_lag_score",
    "scan_date_range",
    "lag_features",
    "rolling_mean",
    "ewm_mean",
    "xs_rank_norm",
    "xs_zscore",
    "rank_percentile",
    "feature_chain",
    "all_metrics",
    "backtest_per_date",
    "error_by_symbol",
    "median_fit",
    "sample_by_group",
    "purged_kfold",
    "walk_forward",
    "validate_panel",
    "symbol_mean_baseline",
    "temporal_bias",
    "rank_average",
    "blend_weight_search",
    "ridge",
    "stream_rolling",
    "cv_train",
]
ONCE = {"stream_rolling", "cv_train"}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        laps = []
        # One warm-up, then the median of three; long runs are timed once.
        for lap in range(1 if name in ONCE else 4):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            laps.append(time.perf_counter() - start)
            if lap == 0 and name not in ONCE:
                laps.clear()
        times[name] = round(statistics.median(laps), 4)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
