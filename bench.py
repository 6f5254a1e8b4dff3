"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores. Each query is
built and run to the end into a sink that keeps nothing. ``random_search`` trains the model
that ``score_pipeline`` loads.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.queries import QUERIES
from vintagelens.session import build_session

HEADLINE = [
    "label_store_pipeline",
    "days_past_due",
    "bad_rate_curve",
    "snapshot_counts",
    "dq_attributes",
    "impute_age_median",
    "feature_store_pipeline",
    "join_eng_left",
    "two_way_fill",
    "training_set_pipeline",
    "stratified_split",
    "scaler_transform",
    "auc_gini",
    "quantile_breakpoints",
    "psi",
    "psi_by_snapshot",
    "score_density",
    "monitor_report",
    "write_predictions",
    "train_pipeline",
    "random_search",
    "score_pipeline",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    QUERIES["bad_rate_curve"](spark, sf_dir).collect()  # start the JVM's compiler before timing
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name:28} {seconds[name]:8.2f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
