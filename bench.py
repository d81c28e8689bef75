"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from tabloom.catalog import collect_registries
from tabloom.session import build_session, drop_stashes

HEADLINE = (
    "time_split_flagship",
    "time_split_report",
    "stratified_split_orders",
    "split_join",
    "cleaned_table",
    "row_ids",
    "rolling_mean",
    "feature_audit",
    "distinct_counts",
    "describe_numeric",
    "correlations",
    "histogram",
    "pivot_ordered_by_total",
    "top_values_by_label",
    "feature_table",
    "encoded_table",
    "classification_report",
    "regression_metrics",
    "curve_areas",
    "one_vs_rest_areas",
    "cluster_agreement",
    "nearest_neighbours",
    "density_clusters",
    "least_squares_line",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.enabled": "false"}
    spark = build_session("tabloom-bench", master=f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    registered, _ = collect_registries()
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()
    took = {}
    for name in names:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    drop_stashes(spark)
    spark.stop()
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))


if __name__ == "__main__":
    main()
