"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Each query is timed from the tables to a drained result (no-op sink), after one
untimed warm run; the value is the sum of the medians. Queries on the modelling set
include nothing of its construction, which is timed as ``final_dataset``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ebbtide.checks.queries import QUERIES  # noqa: E402
from ebbtide.session import local_session  # noqa: E402

HEADLINE = [
    "churn_labels",
    "cohort_analysis",
    "base_features",
    "product_features",
    "behavioral_features",
    "feature_set",
    "final_dataset",
    "days_between_orders",
    "top3_product_groups",
    "summary_stats",
    "data_quality",
    "distinct_counts",
    "rfm_segments",
    "segment_analysis",
    "feature_correlations",
    "recency_histogram",
    "prepared_features",
    "label_encode",
    "roc_auc",
    "pr_curve",
    "insights",
    "train_tier_models",
    "score_members",
]
# Trained once per application, so a second run would only measure the memo.
ONCE = {"train_tier_models"}


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=8)
    seconds = {}
    for name in names:
        def run(name=name):
            return QUERIES[name](spark, folder)

        if name in ONCE:
            seconds[name] = round(timed(run), 3)
            continue
        timed(run)
        seconds[name] = round(statistics.median(timed(run) for _ in range(repeats)), 3)
    print(
        json.dumps(
            {
                "metric": "headline query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "repeats": repeats,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
