"""Queries of what keeps the tables in order: bucket versions, field states, day folders, one commit for several sinks, chunked
backfill and range digests."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unirec.functions.shared import new_folder
from unirec.operators.ranges import SnapshotStore
from unirec.operators.survivorship import Survivorship, provenance
from unirec.operators.upsert import upsert
from unirec.plans.derived import CUSTOMER, INGEST_DATE, as_log, source_events, source_rows, table
from unirec.plans.merge_queries import customer_batch
from unirec.plans.sql import CUSTOMER_ROWS
from unirec.plans.stream_queries import ALL_NOW, BATCH_STAMP, write_log
from unirec.sinks.golden import GoldenTable, SurvivorshipTable
from unirec.sinks.raw import dated, raw_table
from unirec.sources.envelope import decode_events, encode_events
from unirec.sources.topics import file_log, file_log_stream, publish_to_file_log
from unirec.streaming.backfill import backfill_chunks
from unirec.streaming.entity import SINKS, EntityStream

# --- bucket versions ----------------------------------------------------------------------------


def golden_bucket_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders; then a few change and their buckets alone are folded; then a few are deleted and lie over the base."""
    orders = table(spark, sf_dir, "orders")

    def events(rows: DataFrame, kind: str, status, days: int) -> DataFrame:
        when = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(days=F.lit(days))
        return rows.select(
            F.col("o_orderkey").alias("order_id"), status.alias("status"), F.col("o_totalprice").alias("total"),
            F.lit(kind).alias("_event_type"), F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("_event_timestamp"))

    ends = orders.groupBy("o_orderpriority").agg(F.max("o_orderkey").alias("high"), F.min("o_orderkey").alias("low"))
    last = orders.join(ends.select(F.col("high").alias("o_orderkey")), "o_orderkey")
    first = orders.join(ends.select(F.col("low").alias("o_orderkey")), "o_orderkey")
    batches = [
        events(orders, "SNAPSHOT", F.col("o_orderstatus"), 0), events(last, "UPDATE", F.lit("changed"), 1),
        events(first, "DELETE", F.col("o_orderstatus"), 1).unionByName(events(last, "UPDATE", F.lit("late"), -1))]
    golden = GoldenTable(spark, new_folder(spark, "golden-buckets"), batches[0].schema, ["order_id"], "event_time", "remove", buckets=64)
    golden.write_batch(batches[0], 0)
    golden.compact()
    golden.write_batch(batches[1], 1)
    golden.compact()
    golden.write_batch(batches[2], 2)
    return golden.read()


GOLDEN_SQL = """
WITH ends AS (SELECT max(o_orderkey) AS high, min(o_orderkey) AS low FROM orders GROUP BY o_orderpriority)
SELECT o_orderkey AS order_id, CASE WHEN o_orderkey IN (SELECT high FROM ends) THEN 'changed' ELSE o_orderstatus END AS status,
  o_totalprice AS total, CASE WHEN o_orderkey IN (SELECT high FROM ends) THEN 'UPDATE' ELSE 'SNAPSHOT' END AS _event_type,
  strftime(CAST(o_orderdate AS TIMESTAMP) + to_days(CASE WHEN o_orderkey IN (SELECT high FROM ends) THEN 1 ELSE 0 END), '%Y-%m-%dT%H:%M:%S+00:00') AS _event_timestamp
FROM orders WHERE o_orderkey NOT IN (SELECT low FROM ends)"""

# --- field states -------------------------------------------------------------------------------

RULE = Survivorship(("customer_id",), ("name", "nation_id", "balance", "segment"), ("sqlserver", "teradata", "postgres"), newest=("segment",))


def survivor_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three snapshots, updates of one source, and deletes of another."""
    def told_apart(rows: DataFrame) -> DataFrame:
        name = F.when(~((F.col("_source") == "sqlserver") & (F.col("nation_id") < 5)), F.concat_ws("-", "name", "_source"))
        return rows.withColumns({"name": name, "segment": F.concat_ws("-", "segment", "_source")})

    def moved(rows: DataFrame, days: int, kind: str) -> DataFrame:
        later = F.date_format(F.col("_event_timestamp").cast("timestamp") + F.make_dt_interval(days=F.lit(days)), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
        return rows.withColumns({"_event_timestamp": later, "_event_type": F.lit(kind)})

    snapshots = {s: told_apart(customer_batch(spark, sf_dir, s)) for s in RULE.sources}
    updates = moved(snapshots["postgres"].filter("nation_id > 20"), 40, "UPDATE").withColumns(
        {"balance": F.col("balance") + 1, "segment": F.lit("moved")})
    deletes = moved(snapshots["sqlserver"].filter("balance < 0"), 60, "DELETE")
    return [snapshots["teradata"], deletes, updates, snapshots["postgres"], snapshots["sqlserver"]]


def survivors(spark: SparkSession, sf_dir: str) -> SurvivorshipTable:
    """The batches in an order that is not that of their times, with a compaction in between."""
    batches = survivor_batches(spark, sf_dir)
    states = SurvivorshipTable(spark, new_folder(spark, "survivors"), batches[0].schema, RULE, buckets=8)
    for number, batch in enumerate(batches):
        states.write_events(batch, number)
        if number == 2:
            states.compact()
    return states


def upsert_survivorship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors(spark, sf_dir).records()


def survivorship_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = provenance(survivors(spark, sf_dir).read(), RULE)
    return rows.groupBy("field", "source").agg(F.count("*").alias("n_rows"), F.max(F.col("time").cast("timestamp")).alias("newest"))


SURVIVOR_ROWS = f"""
WITH {CUSTOMER_ROWS},
told AS (SELECT customer_id, CASE WHEN NOT (_source = 'sqlserver' AND nation_id < 5) THEN name || '-' || _source END AS name, nation_id, balance,
    segment || '-' || _source AS segment, updated_at, _source FROM customer_rows),
events AS (
  SELECT * FROM told WHERE NOT (_source = 'sqlserver' AND balance < 0)
  UNION ALL SELECT customer_id, name, nation_id, balance + 1, 'moved', updated_at + to_days(40), _source FROM told
  WHERE _source = 'postgres' AND nation_id > 20),
ranked AS (SELECT *, epoch_us(updated_at) AS t,
    CASE _source WHEN 'sqlserver' THEN 3 WHEN 'teradata' THEN 2 ELSE 1 END * 100000000000000000 + epoch_us(updated_at) AS trust FROM events)"""
SURVIVOR_SQL = SURVIVOR_ROWS + """
SELECT customer_id, arg_max(name, trust) FILTER (name IS NOT NULL) AS name, arg_max(nation_id, trust) AS nation_id,
  arg_max(balance, trust) FILTER (balance IS NOT NULL) AS balance, arg_max(segment, t) AS segment
FROM ranked GROUP BY customer_id"""
PROVENANCE_SQL = SURVIVOR_ROWS + """,
chosen AS (
  SELECT 'name' AS field, arg_max(_source, trust) FILTER (name IS NOT NULL) AS source, arg_max(updated_at, trust) FILTER (name IS NOT NULL) AS t FROM ranked GROUP BY customer_id
  UNION ALL SELECT 'nation_id', arg_max(_source, trust), arg_max(updated_at, trust) FROM ranked GROUP BY customer_id
  UNION ALL SELECT 'balance', arg_max(_source, trust) FILTER (balance IS NOT NULL), arg_max(updated_at, trust) FILTER (balance IS NOT NULL) FROM ranked GROUP BY customer_id
  UNION ALL SELECT 'segment', arg_max(_source, t), arg_max(updated_at, t) FROM ranked GROUP BY customer_id)
SELECT field, source, count(*) AS n_rows, max(t) AS newest FROM chosen GROUP BY field, source"""

# --- day folders --------------------------------------------------------------------------------

FOLDED = [date(2024, 1, d) for d in (1, 2)]


def raw_day_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources on the days of their events, one of them replayed, a third on one day; two finished days are folded."""
    def decoded(source: str) -> DataFrame:
        return decode_events(as_log(source_events(spark, sf_dir, "customer", source)))

    own_day = F.to_date(F.col("event_timestamp").cast("timestamp"))
    first = decoded("postgres")
    rows = raw_table(spark, new_folder(spark, "raw-days"), first.schema)
    rows.write_batch(dated(first, own_day), 0)
    for _ in range(2):
        rows.write_batch(dated(decoded("sqlserver"), own_day), 1)
    rows.write_batch(dated(decoded("teradata"), INGEST_DATE), 2, days=[INGEST_DATE])
    for day in FOLDED:
        rows.fold_day(day)
    return rows.read().groupBy("_ingest_date", "source", "_batch_id").agg(
        F.count("*").alias("n_rows"), F.countDistinct("event_id").alias("n_ids"))


DAYS_SQL = f"""
WITH {CUSTOMER_ROWS}
SELECT CASE WHEN _source = 'teradata' THEN DATE '2024-02-01' ELSE CAST(updated_at AS DATE) END AS _ingest_date, _source AS source,
  CAST(CASE _source WHEN 'postgres' THEN 0 WHEN 'sqlserver' THEN 1 ELSE 2 END AS BIGINT) AS _batch_id, count(*) AS n_rows, count(*) AS n_ids
FROM customer_rows GROUP BY ALL"""

# --- one commit ---------------------------------------------------------------------------------


class FailsAtTheLastSink(EntityStream):
    def write_warehouse(self, mapped: DataFrame, batch_id: int, day: date) -> dict:
        raise RuntimeError("the sinks before this one have written their files")


def fan_out_atomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers of the three sinks see after a batch that failed between two sinks, and after its repetition."""
    folder = new_folder(spark, "atomic")

    def run(kind: type[EntityStream]) -> EntityStream:
        stream = kind(spark, CUSTOMER, folder, mode="event_time", ingest_date=INGEST_DATE, batch_timestamp=BATCH_STAMP)
        query = stream.start(file_log_stream(spark, f"{folder}/log", ["customer"]), SINKS, ALL_NOW)
        if kind is FailsAtTheLastSink:
            try:
                query.awaitTermination()
            except Exception as failed:
                if "the sinks before this one" not in str(failed):
                    raise
        else:
            query.awaitTermination()
        return stream

    def seen(moment: str) -> DataFrame:
        stream = EntityStream(spark, CUSTOMER, folder, mode="event_time", ingest_date=INGEST_DATE)
        sinks = {"raw": stream.read_raw(), "canonical": stream.read_canonical(), "warehouse": stream.read_warehouse()}
        counts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(moment).alias("moment"), F.lit(s).alias("sink"), "n_rows") for s, df in sinks.items()]
        return counts[0].unionByName(counts[1]).unionByName(counts[2])

    write_log(spark, sf_dir, folder, "customer", ["postgres", "teradata"])
    run(EntityStream)
    write_log(spark, sf_dir, folder, "customer", ["sqlserver"])
    run(FailsAtTheLastSink)
    # Read now: the files of the attempt go when the batch is repeated.
    failed = spark.createDataFrame(seen("failed").collect(), "moment string, sink string, n_rows bigint")
    run(EntityStream)
    return failed.unionByName(seen("repeated"))


ATOMIC_SQL = """
SELECT moment, sink, CAST(CASE WHEN sink = 'canonical' THEN n WHEN moment = 'failed' THEN 2 * n ELSE 3 * n END AS BIGINT) AS n_rows
FROM (SELECT count(*) AS n FROM customer), (VALUES ('failed'), ('repeated')) m(moment), (VALUES ('raw'), ('canonical'), ('warehouse')) s(sink)"""

# --- chunked backfill ---------------------------------------------------------------------------

LIVE_NATION = 3


def backfill_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source is published by key ranges while one nation's customers change; the run breaks off and goes on.  The
    last event of a key in the log is its newest, though some chunks were read before the change."""
    folder = new_folder(spark, "chunks")
    log, changed = f"{folder}/log", []
    rows = source_rows(spark, sf_dir, "customer", "postgres")
    live = rows.withColumn("segment", F.when(F.col("nation_id") == LIVE_NATION, "live").otherwise(F.col("segment")))

    def poll(chunk: int) -> None:
        if chunk == 1 and not changed:
            changed.append(chunk)
            publish_to_file_log(encode_events(live.filter(F.col("nation_id") == LIVE_NATION), "postgres", "customer", "UPDATE", key=F.col("id")), log)

    for most in (3, None):
        backfill_chunks(lambda: live if changed else rows, "postgres", "customer", "id", log, f"{folder}/chunk", 6, poll, most)
    payload = F.col("payload")
    events = decode_events(file_log(spark, log, ["customer"])).select(
        F.get_json_object(payload, "$.id").cast("bigint").alias("id"), F.get_json_object(payload, "$.segment").alias("segment"), "kafka_offset")
    return upsert(None, events, ["id"], order=[F.col("kafka_offset")]).drop("kafka_offset")


CHUNKS_SQL = f"""
SELECT c_custkey AS id, CASE WHEN c_nationkey = {LIVE_NATION} THEN 'live' ELSE c_mktsegment END AS segment FROM customer"""

# --- range digests ------------------------------------------------------------------------------


def snapshot_diff_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored snapshots of the orders: the newest keys are new, the oldest gone, a few in between changed."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    ends = orders.agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")).first()
    width = max(1, (ends["high"] - ends["low"]) // 100)
    old = orders.filter(F.col("o_orderkey") <= ends["high"] - width)
    middle = (ends["low"] + ends["high"]) // 2
    moved = F.col("o_orderkey").between(middle, middle + width)
    new = orders.filter(F.col("o_orderkey") >= ends["low"] + width).withColumn(
        "o_totalprice", F.when(moved, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    store = SnapshotStore(spark, new_folder(spark, "snapshots"), orders.schema, ["o_orderkey"], ranges=32)
    store.write(old, "1")
    store.write(new, "2")
    return store.diff("1", "2").select("event_type", "o_orderkey", "o_totalprice", F.col("before.o_totalprice").alias("before_price"))


RANGES_SQL = """
WITH e AS (SELECT min(o_orderkey) AS low, max(o_orderkey) AS high, greatest(1, (max(o_orderkey) - min(o_orderkey)) // 100) AS w,
    (min(o_orderkey) + max(o_orderkey)) // 2 AS mid FROM orders)
SELECT 'INSERT' AS event_type, o_orderkey, o_totalprice, CAST(NULL AS DOUBLE) AS before_price FROM orders, e WHERE o_orderkey > high - w
UNION ALL SELECT 'DELETE', o_orderkey, o_totalprice, o_totalprice FROM orders, e WHERE o_orderkey < low + w
UNION ALL SELECT 'UPDATE', o_orderkey, o_totalprice + 1, o_totalprice FROM orders, e WHERE o_orderkey BETWEEN mid AND mid + w"""

QUERIES = {
    "backfill_chunks": backfill_in_chunks,
    "snapshot_diff_ranges": snapshot_diff_ranges,
    "golden_bucket_compaction": golden_bucket_compaction,
    "upsert_survivorship": upsert_survivorship,
    "survivorship_provenance": survivorship_provenance,
    "raw_day_folders": raw_day_folders,
    "fan_out_atomic": fan_out_atomic,
}
ORACLES = {
    "backfill_chunks": CHUNKS_SQL,
    "snapshot_diff_ranges": RANGES_SQL,
    "golden_bucket_compaction": GOLDEN_SQL,
    "upsert_survivorship": SURVIVOR_SQL,
    "survivorship_provenance": PROVENANCE_SQL,
    "raw_day_folders": DAYS_SQL,
    "fan_out_atomic": ATOMIC_SQL,
}
