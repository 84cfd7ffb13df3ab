"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the input folder and
BENCH_CPUS (default 8) the number of local cores. Each query runs once to warm
up and then BENCH_RUNS times (default 3); the median counts. Results go to the
noop sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from daymark.plans.queries import QUERIES as LABEL_QUERIES
from daymark.plans.study import QUERIES as STUDY_QUERIES
from daymark.session import local_session

QUERIES = LABEL_QUERIES | STUDY_QUERIES

HEADLINE = [
    "patient_day",
    "sic_labels",
    "sic_merge_join",
    "sic_merge_onepass",
    "isth_dic_labels",
    "sic_to_dic_isth",
    "jaam_dic_labels",
    "sic_to_dic_jaam",
    "dic_labels_both",
    "lag_delta",
    "sic_labels_big_stays",
    "lag_delta_big_stays",
    "sic_to_dic_jaam_big_stays",
    "cohort",
    "label_tables",
    "label_yield",
    "missingness",
    "auroc",
    "auprc",
    "fairness",
    "logistic",
    "gbt",
    "model_evaluation",
    "permutation_importance",
    "preceding_24_hours",
    "labels_after_new_days",
    "sic_labels_by_date",
    "out_of_fold_rows",
    "free_of_dic",
]


def seconds(spark, name: str, folder: str, runs: int) -> float:
    def once() -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once()
    return statistics.median(once() for _ in range(runs))


def scale(folder: str) -> float | str:
    name = os.path.basename(folder.rstrip("/"))
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, partitions=cores)
    timings = {name: round(seconds(spark, name, folder, runs), 4) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": scale(folder),
            }
        )
    )


if __name__ == "__main__":
    main()
