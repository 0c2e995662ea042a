"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default the largest local ones), ``BENCH_CPUS`` the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from siftwork.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "flagship_clean_profile",
    "a1_tsv_scan",
    "a2_landing_counts",
    "b5_reject_reasons",
    "b13_distinct_documents",
    "b14_stage_switches",
    "c1_missing_profile",
    "c2_median_impute",
    "d1_outlier_profile",
    "d2_iqr_filter",
    "e3_clean_list",
    "f1_top_labels",
    "f4_target_encode",
    "f5_encoder",
    "g5_derived_features",
    "h3_robust",
    "h4_auto_scale",
    "i1_pca_threshold",
    "j1_sample",
    "j2_split",
    "j6_folds",
    "k1_logistic",
    "k2_knn",
    "k2_knn_cells",
    "k4_random_forest",
    "k11_report",
    "l6_box_stats",
    "l7_histogram",
    "l9_spearman",
    "l12_describe",
    "m1_leaderboard",
    "st1_landing_counters",
    "st2_stream_scoring",
]


def run(query, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("siftwork-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's compiler and the Python workers before the clock runs.
    run(QUERIES["flagship_clean_profile"], spark, sf_dir)
    times = {name: round(run(QUERIES[name], spark, sf_dir), 3) for name in HEADLINE}
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
