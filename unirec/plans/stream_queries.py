"""Queries that run as streams over a log written from the given tables, until it is used up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unirec.functions.shared import new_folder
from unirec.plans.derived import (
    ACTIVITY, CUSTOMER, DATABASES, INGEST_DATE, ORDER, SOURCES, as_log, encode_tasks, source_events, source_rows, table,
)
from unirec.plans.mapping_queries import ACTIVITY_ROWS
from unirec.plans.sql import CUSTOMER_ROWS, ORDER_ROWS, canonical, latest
from unirec.sources.envelope import decode_events, encode_events
from unirec.sources.topics import file_log_stream
from unirec.streaming.entity import EntityStream, drop_repeated_events
from unirec.streaming.monitor import stop_gracefully

ALL_NOW = {"availableNow": True}
# The least files of an append: few, so that small logs make several batches too; the results do not depend on where batches end.
FILES_PER_BATCH = 2
BATCH_STAMP = "2024-02-01T00:00:00.000000+00:00"
POSITION = ("_partition", "_offset")


def log_files(spark: SparkSession, sf_dir: str, entity: str, source: str) -> int:
    """Files of one append, and so of one batch: as many as tasks encode the events, so that no task writes or reads more as
    the source grows."""
    rows = source_rows(spark, sf_dir, entity, source)
    return max(FILES_PER_BATCH, encode_tasks(rows) or rows.rdd.getNumPartitions())


def write_log(spark: SparkSession, sf_dir: str, folder: str, entity: str, sources: Sequence[str] | None = None) -> str:
    """One append per source, so that a stream can take the sources in several batches.  Only an append of the least files is
    dealt to them; otherwise the tasks that encode the events write them."""
    path = f"{folder}/log"
    for source in sources or SOURCES[entity]:
        rows = as_log(source_events(spark, sf_dir, entity, source))
        if log_files(spark, sf_dir, entity, source) == FILES_PER_BATCH:
            rows = rows.repartition(FILES_PER_BATCH)
        rows.write.mode("append").partitionBy("topic").parquet(path)
    return path


def run_entity(
    spark: SparkSession, sf_dir: str, spec, sinks: Sequence[str], split: bool = True,
    sources: Sequence[str] | None = None, **options,
):
    folder = new_folder(spark, f"stream-{spec.name}")
    log = write_log(spark, sf_dir, folder, spec.name, sources)
    stream = EntityStream(
        spark, spec, folder, ingest_date=INGEST_DATE, batch_timestamp=BATCH_STAMP,
        sources=tuple(sources or SOURCES[spec.name]), **options)
    files = max(log_files(spark, sf_dir, spec.name, s) for s in stream.sources) if split else None
    query = stream.start(file_log_stream(spark, log, [spec.name], max_files_per_trigger=files), sinks, ALL_NOW)
    query.awaitTermination()
    return stream, query


def stream_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, _ = run_entity(spark, sf_dir, CUSTOMER, ["raw"], split=False)
    return stream.read_raw().select(
        "event_type", "source", "entity", "event_timestamp", "source_table", "source_database", "_ingest_date")


def stream_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several batches; the newest event of a key stays, however the batches fall."""
    stream, _ = run_entity(spark, sf_dir, CUSTOMER, ["canonical"], mode="event_time")
    return stream.read_canonical().drop(*POSITION)


def stream_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files in one batch: inside a batch the newest event of a key wins."""
    stream, _ = run_entity(spark, sf_dir, ORDER, ["canonical"], split=False)
    return stream.read_canonical().drop(*POSITION)


def stream_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few users hold all events."""
    stream, _ = run_entity(spark, sf_dir, ACTIVITY, ["canonical"], mode="event_time")
    return stream.read_canonical().drop(*POSITION, "props")


def stream_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, _ = run_entity(spark, sf_dir, CUSTOMER, ["warehouse"])
    return stream.read_warehouse().drop(*POSITION, "_run", "_batch_id")


def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query feeds all three sinks; their row counts next to each other."""
    stream, _ = run_entity(spark, sf_dir, CUSTOMER, ["raw", "canonical", "warehouse"], mode="event_time")

    def rows(df: DataFrame, sink: str, source: str) -> DataFrame:
        return df.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n_rows")).select(
            F.lit(sink).alias("sink"), "source", "n_rows")

    return rows(stream.read_raw(), "raw", "source").unionByName(
        rows(stream.read_canonical(), "canonical", "_source")).unionByName(
        rows(stream.read_warehouse(), "warehouse", "_source"))


def stream_multi_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several topics as one stream."""
    folder = new_folder(spark, "stream-multi")
    for entity in ("customer", "order", "activity"):
        log = write_log(spark, sf_dir, folder, entity)
    decoded = decode_events(file_log_stream(spark, log, ["customer", "order", "activity"]))
    query = (decoded.writeStream.format("parquet").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/checkpoint").trigger(**ALL_NOW).start())
    query.awaitTermination()
    return spark.read.schema(decoded.schema).parquet(f"{folder}/out").groupBy("entity", "source").agg(
        F.count("*").alias("n_events"), F.max(F.col("event_timestamp").cast("timestamp")).alias("newest"))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source without timestamps is published twice as a whole; each row arrives once."""
    folder = new_folder(spark, "stream-dedup")
    events = encode_events(
        table(spark, sf_dir, "supplier"), "sqlserver", "supplier", "INSERT", key=F.col("s_suppkey"),
        database=DATABASES["sqlserver"], event_time=F.lit("2024-01-01 00:00:00").cast("timestamp"))
    for _ in range(2):
        as_log(events).write.mode("append").partitionBy("topic").parquet(f"{folder}/log")
    decoded = decode_events(file_log_stream(spark, f"{folder}/log", ["supplier"]))
    once = drop_repeated_events(decoded, "1 hour")
    query = (once.writeStream.format("parquet").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/checkpoint").trigger(**ALL_NOW).start())
    query.awaitTermination()
    return spark.read.schema(once.schema).parquet(f"{folder}/out").select(
        "event_type", F.get_json_object("payload", "$.s_suppkey").cast("bigint").alias("s_suppkey"))


def stream_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query that runs by the clock while the log grows, stopped between two batches and started again."""
    folder = new_folder(spark, "stream-clock")
    for sources in (["postgres"], ["sqlserver", "teradata"]):
        log = write_log(spark, sf_dir, folder, "customer", sources[:1])
        stream = EntityStream(spark, CUSTOMER, folder, mode="event_time", ingest_date=INGEST_DATE, batch_timestamp=BATCH_STAMP)
        query = stream.start(file_log_stream(spark, log, ["customer"]), ["canonical"], {"processingTime": "500 milliseconds"})
        query.processAllAvailable()
        for source in sources[1:]:
            write_log(spark, sf_dir, folder, "customer", [source])
            query.processAllAvailable()
        stop_gracefully([query])
    return stream.read_canonical().drop(*POSITION)


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After the stream, its last batches are written again as a restart would do; nothing changes."""
    stream, query = run_entity(spark, sf_dir, CUSTOMER, ["canonical", "warehouse"], mode="event_time")
    run, last = stream.golden.last_batch()
    repeated = stream.read_warehouse().filter((F.col("_run") == run) & (F.col("_batch_id") == last))
    batch = repeated.drop("_run", "_batch_id", "_batch_timestamp")
    for _ in range(2):
        stream.golden.write_batch(batch, last, run)
    return stream.read_canonical().drop(*POSITION)


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input rows over all batches, from the stored counts: every row of the log is read once."""
    stream, _ = run_entity(spark, sf_dir, CUSTOMER, ["canonical", "warehouse"], mode="event_time")
    return stream.read_counts().filter("sink = 'input'").groupBy(
        F.concat_ws("_", "query", F.lit(CUSTOMER.name)).alias("query")).agg(F.sum("n_rows").alias("n_rows"))


def batch_sink_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows handed to each sink, added up over the batches."""
    stream, _ = run_entity(spark, sf_dir, CUSTOMER, ["raw", "canonical", "warehouse"], mode="event_time")
    return stream.read_counts().groupBy("sink").agg(F.sum("n_rows").alias("n_rows"))


def dedup_keeps_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and unreadable rows, all published twice: an event arrives once, every unreadable row stays."""
    folder = new_folder(spark, "stream-dead")
    base = table(spark, sf_dir, "supplier")
    events = encode_events(base, "sqlserver", "supplier", "INSERT", key=F.col("s_suppkey"), version=F.lit("1"))
    broken = base.select(F.col("s_name").alias("_broken"), F.col("s_suppkey").alias("_at"))
    for k in range(2):
        good = as_log(events)
        bad = broken.select(
            F.lit(None).cast("binary").alias("key"), F.encode("_broken", "UTF-8").alias("value"),
            F.lit("canonical.supplier").alias("topic"), F.lit(0).alias("partition"),
            (F.col("_at") * 2 + k).alias("offset"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"))
        good.unionByName(bad).write.mode("append").partitionBy("topic").parquet(f"{folder}/log")
    once = drop_repeated_events(decode_events(file_log_stream(spark, f"{folder}/log", ["supplier"]), keep_raw=True), "1 hour")
    query = (once.writeStream.format("parquet").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/checkpoint").trigger(**ALL_NOW).start())
    query.awaitTermination()
    rows = spark.read.schema(once.schema).parquet(f"{folder}/out")
    return rows.groupBy(F.col("event_id").isNull().alias("dead")).agg(F.count("*").alias("n_rows"))


LATEST_CUSTOMER = f"""WITH {CUSTOMER_ROWS}, c AS ({canonical('customer_rows')})
{latest('c', 'customer_id', 'updated_at DESC')}"""

QUERIES = {
    "stream_raw": stream_raw,
    "stream_canonical_upsert": stream_canonical,
    "stream_canonical_arrival": stream_arrival,
    "stream_hot_keys": stream_hot_keys,
    "stream_warehouse": stream_warehouse,
    "stream_fan_out": stream_fan_out,
    "stream_multi_entity": stream_multi_entity,
    "stream_dedup_events": stream_dedup,
    "stream_replay_idempotent": stream_replay,
    "stream_progress": stream_progress,
    "stream_processing_time": stream_processing_time,
    "batch_sink_counts": batch_sink_counts,
    "dedup_keeps_dead_letters": dedup_keeps_dead_letters,
}
ORACLES = {
    "stream_raw": f"""WITH {CUSTOMER_ROWS}
SELECT _event_type AS event_type, _source AS source, 'customer' AS entity, _event_timestamp AS event_timestamp,
  CASE _source WHEN 'postgres' THEN 'customer' WHEN 'sqlserver' THEN 'customers' ELSE 'CUSTOMER' END AS source_table,
  CASE _source WHEN 'postgres' THEN 'customers_db' WHEN 'sqlserver' THEN 'CRM_DB' ELSE 'warehouse' END AS source_database,
  _ingest_date FROM ({canonical('customer_rows')})""",
    "stream_canonical_upsert": LATEST_CUSTOMER,
    "stream_canonical_arrival": f"""WITH {ORDER_ROWS}, c AS ({canonical('order_rows')})
{latest('c', 'order_id', 'updated_at DESC')}""",
    "stream_hot_keys": f"""WITH {ACTIVITY_ROWS}, c AS ({canonical('activity_rows')})
SELECT * EXCLUDE (props_k) FROM ({latest('c', 'user_id', 'updated_at DESC, event_id DESC')})""",
    "stream_warehouse": f"""WITH {CUSTOMER_ROWS}
SELECT *, '{BATCH_STAMP}' AS _batch_timestamp FROM ({canonical('customer_rows')})""",
    "stream_fan_out": f"""WITH {CUSTOMER_ROWS}, c AS ({canonical('customer_rows')}),
g AS ({latest('c', 'customer_id', 'updated_at DESC')})
SELECT 'raw' AS sink, _source AS source, count(*) AS n_rows FROM c GROUP BY _source
UNION ALL SELECT 'canonical', _source, count(*) FROM g GROUP BY _source
UNION ALL SELECT 'warehouse', _source, count(*) FROM c GROUP BY _source""",
    "stream_multi_entity": f"""WITH {CUSTOMER_ROWS}, {ORDER_ROWS}, {ACTIVITY_ROWS}
SELECT 'customer' AS entity, _source AS source, count(*) AS n_events, max(updated_at) AS newest FROM customer_rows GROUP BY _source
UNION ALL SELECT 'order', _source, count(*), max(updated_at) FROM order_rows GROUP BY _source
UNION ALL SELECT 'activity', _source, count(*), max(updated_at) FROM activity_rows GROUP BY _source""",
    "stream_dedup_events": "SELECT 'INSERT' AS event_type, s_suppkey FROM supplier",
    "stream_replay_idempotent": LATEST_CUSTOMER,
    "stream_processing_time": LATEST_CUSTOMER,
    "batch_sink_counts": """
SELECT s.sink, CAST(CASE WHEN s.sink IN ('dead_letters', 'quarantine') THEN 0 ELSE 3 * n END AS BIGINT) AS n_rows
FROM (SELECT count(*) AS n FROM customer), (VALUES ('input'), ('raw'), ('dead_letters'), ('canonical'), ('quarantine'), ('warehouse')) s(sink)""",
    "dedup_keeps_dead_letters": "SELECT false AS dead, count(*) AS n_rows FROM supplier UNION ALL SELECT true, 2 * count(*) FROM supplier",
    "stream_progress": "SELECT 'canonical_warehouse_customer' AS query, 3 * count(*) AS n_rows FROM customer",
}
