"""Headline queries at one scale; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from tillcast.catalog import QUERIES
from tillcast.session import build_session

HEADLINE = (
    "daily_series", "densify_calendar", "build_supervised", "dedup_exact", "ingestion_report", "top_countries_by_revenue",
    "price_stats", "regression_metrics", "batch_predict", "ridge_forecast", "retrain_all_series",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", spark__driver__memory="16g", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for key in HEADLINE:
        begun = time.time()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[key] = round(time.time() - begun, 3)
        print(key, seconds[key], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
