"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tollgate.queries import QUERIES

HEADLINE = [
    "raw_scan_typed",
    "clean_kept",
    "clean_report",
    "dedup_latest",
    "load_new_files",
    "labelled_features",
    "nb_scores",
    "nb_grid_metrics",
    "classifier_metrics",
    "ranked_auc",
    "forest_scores",
    "bootstrap_auc",
    "t_test_models",
    "register_version",
    "stream_scores",
    "stream_volume_window",
    "scaling_signal",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    spent = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(spent.values()), 3)
    sf = os.path.basename(os.path.normpath(sf_dir))
    print(
        json.dumps(
            {"metric": "total_query_time", "value": total, "unit": "sec", "queries": spent, "sf": sf}
        )
    )


if __name__ == "__main__":
    main()
