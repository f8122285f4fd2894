"""Wall time of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F

from airmill.plans import catalog
from airmill.session import get_session

HEADLINE = [
    "silver_anomaly_rate", "silver_features", "silver_dedup", "bronze_parse", "ingest_quality", "score_readings",
    "rolling_mean", "rolling_global", "sensor_profile", "drift_features", "ks_statistic_ranges", "roc_auc",
    "roc_auc_ranges", "stratified_split", "evaluate_models", "fit_forest", "forest_score", "permutation_importance",
    "champion_challenger", "verdict", "hourly_anomaly_rate",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    partitions = cpus if cpus.isdigit() else "8"
    spark = get_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=partitions, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.registered()
    # start the JVM paths and the Python workers outside the measurement
    queries["gas_summary"](spark, folder).collect()
    queries["forest_score_boxes"](spark, folder).write.format("noop").mode("overwrite").save()
    start_python = F.pandas_udf(lambda x: x + 1, "bigint")
    spark.range(0, 1000, 1, int(partitions)).select(start_python("id")).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_wall_time", "value": total, "unit": "sec", "queries": times, "sf": folder.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
