"""Queries of the sinks in batch: raw table, warehouse table, datetime columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unirec.functions.shared import new_folder
from unirec.operators.mapping import canonicalise
from unirec.plans.derived import CUSTOMER, INGEST_DATE, as_log, source_events, table
from unirec.plans.sql import CUSTOMER_ROWS, canonical
from unirec.sinks.raw import read_raw, write_raw_batch
from unirec.sinks.warehouse import append_batch, coerce_datetimes, datetime_columns, read_warehouse
from unirec.sources.envelope import decode_events

SOURCES_IN_ORDER = ("postgres", "sqlserver", "teradata")
BATCH_STAMP = "2024-02-01T00:00:00.000000+00:00"


def _decoded(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return decode_events(as_log(source_events(spark, sf_dir, "customer", source)))


def raw_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches, the last of them replayed: rows per partition of the raw table."""
    path = new_folder(spark, "raw")
    for batch_id, source in ((0, "postgres"), (1, "sqlserver"), (2, "teradata"), (2, "teradata")):
        batch = _decoded(spark, sf_dir, source)
        write_raw_batch(batch, path, batch_id, ingest_date=INGEST_DATE)
    rows = read_raw(spark, path, batch.schema)
    return rows.groupBy("_batch_id", "_ingest_date", "source").agg(
        F.count("*").alias("n_rows"), F.countDistinct("event_id").alias("n_ids"),
        F.min(F.col("event_timestamp").cast("timestamp")).alias("oldest"))


def warehouse_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full history, no deduplication: three batches, the last of them replayed."""
    path = new_folder(spark, "warehouse")
    for batch_id, source in ((0, "postgres"), (1, "sqlserver"), (2, "teradata"), (2, "teradata")):
        batch = canonicalise(_decoded(spark, sf_dir, source), CUSTOMER, ingest_date=INGEST_DATE, sources=(source,))
        append_batch(batch, path, batch_id, batch_timestamp=BATCH_STAMP)
    return read_warehouse(spark, path, batch.schema).drop("_partition", "_offset", "_run")


def coerce_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns become timestamps only when they read as such as a whole."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("as_iso"),
        F.date_format("ts", "yyyy-MM-dd").alias("as_day"),
        F.when(F.col("event_type") == "error", "unknown").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("as_mixed"),
        F.col("event_type").alias("as_text"),
    )
    return coerce_datetimes(events, datetime_columns(events))


QUERIES = {
    "raw_append_partitions": raw_append,
    "warehouse_append_batches": warehouse_append,
    "coerce_datetime_columns": coerce_columns,
}
ORACLES = {
    "raw_append_partitions": f"""WITH {CUSTOMER_ROWS}
SELECT CAST(CASE _source WHEN 'postgres' THEN 0 WHEN 'sqlserver' THEN 1 ELSE 2 END AS BIGINT) AS _batch_id,
  DATE '2024-02-01' AS _ingest_date, _source AS source, count(*) AS n_rows, count(*) AS n_ids, min(updated_at) AS oldest
FROM customer_rows GROUP BY _source""",
    "warehouse_append_batches": f"""WITH {CUSTOMER_ROWS}
SELECT *, CAST(CASE _source WHEN 'postgres' THEN 0 WHEN 'sqlserver' THEN 1 ELSE 2 END AS BIGINT) AS _batch_id,
  '{BATCH_STAMP}' AS _batch_timestamp FROM ({canonical('customer_rows')})""",
    "coerce_datetime_columns": """
SELECT event_id, CAST(ts AS TIMESTAMP) AS as_iso, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS as_day,
  CASE WHEN event_type = 'error' THEN 'unknown' ELSE strftime(ts, '%Y-%m-%d') END AS as_mixed, event_type AS as_text
FROM events""",
}
