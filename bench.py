"""Headline queries, timed. Prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores.
"""

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from claimloom.plans import catalog  # noqa: E402

HEADLINE = [
    "claims_rollup",
    "tier_distribution",
    "group_size_window",
    "semi_join_outpatient",
    "income_left_join",
    "constraint_violations",
    "quarantine_rows",
    "numeric_summary",
    "freq_inverted_index",
    "group_split",
    "group_kfold",
    "stratified_split",
    "frequency_encode",
    "preprocessed_features",
    "confusion_matrix",
    "macro_f1",
    "roc_auc_ovr",
    "regression_metrics",
    "feature_drift_numeric",
    "feature_drift_categorical",
    "windowed_drift",
    "knn_join",
    "tree_tier",
    "linear_charge",
    "score_tier",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("claimloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # Start the JVM's compilers and the Parquet reader before anything is timed.
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
