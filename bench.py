"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload import analyses, flows, genetics, models, preparation, scans, statistics, uploads  # noqa: E402,F401
from workload.registry import QUERIES  # noqa: E402

HEADLINE = [
    "numeric_summary", "missing_values", "dataset_overview", "cohort_size_by_date", "prevalence_by_year",
    "median_trend", "grouped_counts", "price_histogram", "class_histogram", "box_statistics",
    "iqr_outliers", "distinct_rows", "median_fill", "label_encoding",
    "clean_phenotypes", "clean_genotypes", "built_features", "cohort_join", "snp_count_cube",
    "genotype_frequencies", "correlation_matrix", "feature_selection", "chi_square_tests",
    "snp_association_scan", "welch_tests", "false_discovery_adjustment", "feature_screen",
    "stratified_split", "classification_metrics", "roc_curve", "stored_cohort", "scored_arrivals",
    "logistic_training", "forest_training", "model_comparison", "cohort_workflow", "long_clean_genotypes", "joint_feature_screen",
    "ingest_uploads",
]


def main(names: list[str]) -> None:
    from cohortkit.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
