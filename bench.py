"""Time the headline queries on one machine and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores; names given as
arguments replace the headline list (``all`` runs every query).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from txrisk.plans.queries import registered
from txrisk.session import configure

HEADLINE = [
    "csv_roundtrip",
    "clean_transactions",
    "quality_report",
    "dedup_lineitem",
    "removed_duplicates",
    "iqr_filter",
    "feature_table",
    "rolling_features",
    "rolling_features_days",
    "hash_split",
    "oversample",
    "minmax_scaled",
    "category_onehot",
    "threshold_sweep",
    "roc_auc",
    "pr_curve",
    "compare_models",
    "encode_messages",
    "stream_decode",
    "stream_score",
    "stream_rolling_features",
    "stream_rolling_state",
    "batch_score",
    "batch_score_logistic",
    "stream_score_logistic",
    "baseline_training",
    "cv_metrics",
]


def session(cpus: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("txrisk-bench")
    return configure(
        builder,
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="txrisk-bench-"),
        },
    ).getOrCreate()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    queries = registered()
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(queries)
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    queries["scan_transactions"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr)
    line = {
        "metric": "total time of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
        "rows": rows,
        "cpus": int(cpus),
    }
    if "stream_score" in seconds:
        line["stream_messages_per_sec"] = round(rows / seconds["stream_score"], 1)
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
