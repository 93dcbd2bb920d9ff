"""Headline queries, timed.  Prints one JSON line.

Every query runs once on the smallest tables to warm up and is then timed once; its result goes to a sink
that discards rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from unirec.plans.registry import queries  # noqa: E402

HEADLINE = (
    "encode_events", "decode_envelope", "canonical_customer", "canonical_order", "canonical_order_item",
    "map_cast_int", "map_key_case", "map_duplicate_target", "typed_expand", "latest_per_key_window", "latest_per_key_agg", "latest_per_key_composite",
    "latest_per_key_hot", "upsert_insert_update", "upsert_two_batches_arrival", "upsert_event_time_guard",
    "snapshot_diff", "incremental_scan", "wrapped_records", "infer_json_types", "merge_key_candidates",
    "raw_append_partitions", "warehouse_append_batches", "golden_table_batches", "stream_canonical_upsert",
    "stream_fan_out",
)
# Rows that enter a query, for the rate next to the time.
INPUT = {
    "canonical_customer": ("customer", 3), "canonical_order": ("orders", 2), "canonical_order_item": ("lineitem", 1),
    "latest_per_key_window": ("customer", 3), "latest_per_key_composite": ("lineitem", 1),
    "stream_canonical_upsert": ("customer", 3), "stream_fan_out": ("customer", 3),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("unirec.encode.tasks", cpus if cpus.isdigit() else "8")  # the tables are single files
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    smallest = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    warm_dir = smallest if os.path.isdir(smallest) else sf_dir
    times: dict[str, float] = {}
    for name in HEADLINE:
        for folder in (warm_dir, sf_dir):
            start = time.perf_counter()
            known[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    rates = {}
    for name, (table, times_read) in INPUT.items():
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").count() * times_read
        rates[name] = round(rows / times[name])
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "records_per_sec": rates, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
