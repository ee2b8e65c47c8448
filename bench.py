"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every result is computed in full and thrown away. Nothing is cached between queries. Each
query first runs untimed over the smallest sibling folder, if there is one, so that the times
leave out class loading and code generation but no part of the work on the data.
"""

from __future__ import annotations

import json
import os
import time

from shelfcast.plans.catalog import QUERIES
from shelfcast.session import build_session

HEADLINE = [
    "join_fact_store", "lag_features", "rolling_features", "feature_means", "latest_per_store", "business_features",
    "mean_by_storetype_promo", "sum_by_year", "describe_sales", "iqr_outliers", "corr_matrix", "histogram50",
    "dup_count", "validation_report", "scaled_features", "eval_metrics", "forecast_linear_recursive", "whatif_uplift",
    "drift_summary", "knn_top10", "rerank_top3", "error_rate_5m", "latency_pcts", "last_gauge",
    "running_predictions", "stream_latency", "stream_drift", "linear_predict",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_ui_enabled="false",
        spark_driver_memory="16g", spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = f"{os.path.dirname(sf_dir)}/sf0.001"
    seconds, failed = {}, {}
    for name in HEADLINE:
        try:
            if os.path.isdir(warm):
                run(spark, name, warm)
            seconds[name] = round(run(spark, name, sf_dir), 3)
        except Exception as error:  # report it and time the others
            failed[name] = f"{type(error).__name__}: {str(error)[:200]}"
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "failed": failed, "sf": sf_dir.rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
