"""Queries of the scans: snapshot, increment, watermark, wrapped documents, differences as events."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from unirec.functions.shared import new_folder
from unirec.operators.upsert import upsert
from unirec.plans.derived import SOURCES, as_log, source_rows, spread, table
from unirec.plans.sql import customer_time
from unirec.sources.envelope import decode_events, encode_events, serialise, with_position
from unirec.sources.scan import highest_timestamp, incremental_scan, lower_case_columns, unwrap_records
from unirec.sources.topics import file_log
from unirec.sources.watermarks import watermarks
from unirec.streaming.backfill import diff_events, publish_increment

MARK = datetime(2000, 1, 1)
PAGE_ROWS = 50


def snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table as SNAPSHOT events, read back from the log."""
    rows = lower_case_columns(table(spark, sf_dir, "supplier"))
    events = encode_events(
        rows, "teradata", "supplier", table="SUPPLIER", database="warehouse", key=F.col("s_suppkey"),
        event_time=F.lit("2024-01-01 00:00:00").cast("timestamp"))
    decoded = decode_events(as_log(events))
    return decoded.select(
        "event_type", "source", "entity", "source_table",
        F.get_json_object("payload", "$.s_suppkey").cast("bigint").alias("s_suppkey"),
        F.get_json_object("payload", "$.s_name").alias("s_name"),
        F.get_json_object("payload", "$.s_acctbal").cast("double").alias("s_acctbal"))


def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    fresh = incremental_scan(orders, "o_orderdate", MARK)
    return fresh.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))


def watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest time of every source with a time column, next to what an increment above it finds."""
    marks = []
    for entity, sources in SOURCES.items():
        for source, (_, _, _, time) in sources.items():
            if time:
                rows = source_rows(spark, sf_dir, entity, source)
                marks.append(rows.agg(highest_timestamp(time).alias("watermark"), F.count("*").alias("n_rows")).select(
                    F.lit(source).alias("source"), F.lit(entity).alias("entity"), "watermark", "n_rows"))
    return reduce(DataFrame.unionByName, marks)


def poll_with_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two polls of the activity source with a stored watermark: a snapshot, then the increment."""
    folder = new_folder(spark, "poll")
    log, state = f"{folder}/log", f"{folder}/watermarks"
    rows = source_rows(spark, sf_dir, "activity", "postgres")
    early = rows.filter(F.col("updated_at") <= F.lit(datetime(2024, 1, 20)))
    for seen in (early, rows):
        publish_increment(seen, "postgres", "activity", "updated_at", log, state, key=F.col("user_id"))
    counted = decode_events(file_log(spark, log, ["activity"])).groupBy("source", "entity", "event_type").agg(
        F.count("*").alias("n_events"), F.countDistinct("event_id").alias("n_ids"),
        F.max("event_timestamp").cast("timestamp").alias("newest"))
    marks = watermarks(spark, state)
    return counted.join(marks, ["source", "entity"])


POLL_SQL = """
WITH e AS (
  SELECT CASE WHEN ts <= TIMESTAMP '2024-01-20' THEN 'SNAPSHOT' ELSE 'INSERT' END AS event_type, CAST(ts AS TIMESTAMP) AS ts
  FROM events)
SELECT 'postgres' AS source, 'activity' AS entity, event_type, count(*) AS n_events, count(*) AS n_ids,
  max(ts) AS newest, (SELECT max(ts) FROM e) AS watermark
FROM e GROUP BY event_type
"""


def documents_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of order rows as a REST source would answer them, in the containers such sources use."""
    orders = spread(table(spark, sf_dir, "orders")).select(
        "o_orderpriority", F.floor(F.col("o_orderkey") / PAGE_ROWS).alias("page"), F.to_json(F.struct(
            F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("total"),
            F.col("o_orderstatus").alias("status"))).alias("record"))
    block = F.to_json(F.struct(F.col("record").alias("text")))
    item = F.when(F.col("o_orderpriority") == "5-LOW", block).otherwise(F.col("record"))
    # A page holds at most PAGE_ROWS rows of a priority, because order keys are unique.
    pages = orders.groupBy("o_orderpriority", "page").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(item), ","), F.lit("]")).alias("items"))
    priority = F.col("o_orderpriority")

    def held(name: str):
        return F.concat(F.lit(f'{{"odata":"x","{name}":'), F.col("items"), F.lit("}"))

    document = (
        F.when(priority == "1-URGENT", held("value")).when(priority == "2-HIGH", held("rows"))
        .when(priority == "3-MEDIUM", held("records")).otherwise(F.col("items"))
    )
    return pages.select("o_orderpriority", document.alias("document"))


def wrapped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = unwrap_records(documents_of_orders(spark, sf_dir), "document", keep=("o_orderpriority",))
    return found.select(
        F.col("o_orderpriority").alias("priority"),
        F.get_json_object("record", "$.id").cast("bigint").alias("id"),
        F.get_json_object("record", "$.total").cast("double").alias("total"),
        F.get_json_object("record", "$.status").alias("status"))


def lower_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    upper = table(spark, sf_dir, "supplier")
    return lower_case_columns(upper.toDF(*[c.upper() for c in upper.columns]))


def diff_as_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two states of the customers as change events, with the previous record of updates and deletes."""
    new = source_rows(spark, sf_dir, "customer", "postgres")
    old = new.filter(F.col("balance") < 9000).withColumn(
        "segment", F.when(F.col("segment") == "BUILDING", "HOUSE").otherwise(F.col("segment")))
    events = diff_events(old, new.filter("balance > 0"), ["id"], "postgres", "customer", "2",
                         event_time=F.col("updated_at"), key=F.col("id"))
    log = as_log(events)
    raw = F.col("value").cast("string")
    return log.select(
        F.get_json_object(raw, "$.event_type").alias("event_type"),
        F.get_json_object(raw, "$.payload.id").cast("bigint").alias("id"),
        F.get_json_object(raw, "$.payload.segment").alias("segment"),
        F.get_json_object(raw, "$.before.segment").alias("before_segment"),
        F.get_json_object(raw, "$.before.updated_at").cast("timestamp").alias("before_time"))


def flip_flop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source without change times goes from A to B, back and to B again, and everything is published twice: all
    three changes of each key are events, once each, and the table ends at B."""
    a = source_rows(spark, sf_dir, "customer", "postgres")
    b = a.withColumn("segment", F.lower("segment"))
    states = [a, b, a, b]
    changes = []
    for k in range(1, len(states)):
        events = diff_events(states[k - 1], states[k], ["id"], "postgres", "customer", str(k), key=F.col("id"))
        rows = serialise(events)
        changes.append(with_position(rows, 3, F.lit(k), F.lit("2024-01-01 00:00:00").cast("timestamp")))
    log = reduce(DataFrame.unionByName, changes + changes)
    once = decode_events(log).dropDuplicates(["event_id"])
    rows = once.select(
        F.get_json_object("payload", "$.id").cast("bigint").alias("id"), F.get_json_object("payload", "$.segment").alias("segment"),
        "kafka_offset", F.count("*").over(Window.partitionBy(F.get_json_object("payload", "$.id"))).alias("n_events"))
    return upsert(None, rows, ["id"], order=[F.col("kafka_offset")]).drop("kafka_offset")


DIFF_EVENTS_SQL = f"""
WITH new AS (SELECT c_custkey AS id, c_mktsegment AS segment, c_acctbal AS balance, {customer_time(0)} AS t FROM customer),
old AS (SELECT id, CASE WHEN segment = 'BUILDING' THEN 'HOUSE' ELSE segment END AS segment, balance, t FROM new WHERE balance < 9000)
SELECT 'INSERT' AS event_type, id, segment, NULL AS before_segment, CAST(NULL AS TIMESTAMP) AS before_time
FROM new WHERE balance >= 9000
UNION ALL SELECT 'DELETE', id, segment, segment, t FROM old WHERE balance <= 0
UNION ALL SELECT 'UPDATE', n.id, n.segment, o.segment, o.t FROM new n JOIN old o USING (id)
  WHERE n.balance > 0 AND n.segment <> o.segment
"""

QUERIES = {
    "snapshot_scan": snapshot_scan,
    "incremental_scan": incremental,
    "watermark_advance": watermark_advance,
    "poll_with_watermark": poll_with_watermark,
    "wrapped_records": wrapped_records,
    "lower_case_columns": lower_case,
    "snapshot_diff_events": diff_as_events,
    "diff_events_flip_flop": flip_flop,
}
ORACLES = {
    "snapshot_scan": """SELECT 'SNAPSHOT' AS event_type, 'teradata' AS source, 'supplier' AS entity,
  'SUPPLIER' AS source_table, s_suppkey, s_name, s_acctbal FROM supplier""",
    "incremental_scan": """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate
FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'""",
    "watermark_advance": f"""
SELECT 'postgres' AS source, 'customer' AS entity, max({customer_time(0)}) AS watermark, count(*) AS n_rows FROM customer
UNION ALL SELECT 'sqlserver', 'customer', max({customer_time(1)}), count(*) FROM customer
UNION ALL SELECT 'teradata', 'customer', max({customer_time(2)}), count(*) FROM customer
UNION ALL SELECT 'postgres', 'order', max(CAST(o_orderdate AS TIMESTAMP)), count(*) FROM orders
UNION ALL SELECT 'sqlserver', 'order', max(CAST(o_orderdate AS TIMESTAMP)
  + to_hours(CASE WHEN o_orderstatus = 'F' THEN 12 ELSE -12 END)), count(*) FROM orders
UNION ALL SELECT 'sqlserver', 'order_item', max(CAST(l_shipdate AS TIMESTAMP)), count(*) FROM lineitem
UNION ALL SELECT 'postgres', 'activity', max(CAST(ts AS TIMESTAMP)), count(*) FROM events""",
    "poll_with_watermark": POLL_SQL,
    "wrapped_records": """SELECT o_orderpriority AS priority, o_orderkey AS id, o_totalprice AS total,
  o_orderstatus AS status FROM orders""",
    "lower_case_columns": "SELECT * FROM supplier",
    "snapshot_diff_events": DIFF_EVENTS_SQL,
    "diff_events_flip_flop": "SELECT c_custkey AS id, lower(c_mktsegment) AS segment, 3 AS n_events FROM customer",
}
