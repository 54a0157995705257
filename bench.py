"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 1, the best
run counts). One uncounted query starts the session.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from haulyard.catalog.queries import QUERIES
from haulyard.session import build_session, release

HEADLINE = [
    "bookings_clean",
    "bookings_features",
    "spark_etl_features",
    "iot_features",
    "weather_features",
    "iot_enriched",
    "bookings_enriched",
    "median_impute",
    "nearest_city",
    "delivery_kpis",
    "top_routes",
    "route_analysis",
    "status_breakdown",
    "tier_performance",
    "anomalous_vehicles",
    "dq_bookings",
    "delivery_extract",
    "balanced_train",
    "label_encode",
    "ml_features",
    "auc",
    "contamination_cut",
    "alarm_states",
    "iforest",
    "lof",
    "delay_models",
    "stream_iot_features",
]


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds(spark, "status_breakdown", folder)
    times = {n: round(min(seconds(spark, n, folder) for _ in range(runs)), 3) for n in names}
    line = {"metric": "headline query seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times}
    release(spark)
    print(json.dumps(line | {"sf": folder.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
