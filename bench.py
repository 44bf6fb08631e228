"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from stopflow.plans import catalog
from stopflow.session import build_session

HEADLINE = [
    "scan_quarters_by_name",
    "dedup_keep_first",
    "verify_load",
    "top10_stops",
    "weekday_mean",
    "week_over_week",
    "congestion_top20",
    "undefined_rate",
    "stop_day",
    "pivot_category",
    "feature_pipeline",
    "stop_stats",
    "zscore",
    "short_term_features",
    "isolation_forest",
    "stop_profile",
    "kmeans_profiles",
    "linear_model",
    "decision_tree",
    "random_forest",
    "boosted_trees",
    "long_term_forecast",
    "drift_distances",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(os.environ.get("BENCH_CPUS", "8"), spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["list_stops"](spark, folder).collect()
    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        started = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        spark.catalog.clearCache()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total headline query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
