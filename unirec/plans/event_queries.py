"""Queries over the envelope: encoding, decoding, dead letters, keys, topics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unirec.operators.counts import event_counts
from unirec.plans.derived import SOURCES, as_log, entity_log, source_events, source_rows, table
from unirec.plans.sql import ISO, customer_time
from unirec.sources.envelope import dead_letters, decode_events, event_key, topic_name


def encode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = entity_log(spark, sf_dir, "customer")
    keyed = log.withColumn("partition", F.lit(0))
    decoded = decode_events(keyed.withColumn("topic", F.concat_ws("|", "topic", F.col("key").cast("string"))), keep_raw=True)
    return decoded.select(
        "event_id", "event_type", "source", "entity", "event_timestamp", "source_table", "source_database",
        F.substring_index("raw_topic", "|", 1).alias("topic"), F.substring_index("raw_topic", "|", -1).alias("record_key"))


ENCODE_SQL = f"""
WITH rows AS (
  SELECT 'postgres' AS source, 'customer' AS source_table, 'customers_db' AS source_database, c_custkey AS k,
         {customer_time(0)} AS t, [CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR),
          CAST(c_acctbal AS VARCHAR), c_mktsegment] AS fields FROM customer
  UNION ALL
  SELECT 'sqlserver', 'customers', 'CRM_DB', c_custkey, {customer_time(1)},
         [CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), CAST(c_acctbal AS VARCHAR),
          lower(c_mktsegment)] FROM customer
  UNION ALL
  SELECT 'teradata', 'CUSTOMER', 'warehouse', c_custkey, {customer_time(2)},
         [CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment] FROM customer
)
SELECT sha256(CAST(to_json(list_concat(
         [source, 'customer', source_table, CAST(k AS VARCHAR), strftime(t, {ISO}), 'ROW'],
         fields, [strftime(t, '%Y-%m-%d %H:%M:%S')])) AS VARCHAR)) AS event_id,
       'SNAPSHOT' AS event_type, source, 'customer' AS entity, strftime(t, {ISO}) AS event_timestamp,
       source_table, source_database, 'canonical.customer' AS topic, CAST(k AS VARCHAR) AS record_key
FROM rows
"""


def decode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_events(entity_log(spark, sf_dir, "order"))

    def text(path: str):
        return F.get_json_object("payload", path)

    return decoded.select(
        "kafka_offset", "kafka_timestamp", "event_type", "source", "entity", "event_timestamp", "source_table",
        "source_database",
        F.coalesce(text("$.id"), text("$.OrderId")).cast("bigint").alias("p_order"),
        F.coalesce(text("$.total"), text("$.Total")).cast("double").alias("p_total"),
        F.coalesce(text("$.priority"), text("$.Priority")).alias("p_priority"),
        text("$.updated_at").cast("timestamp").alias("p_updated_at"),
    )


DECODE_SQL = f"""
WITH rows AS (
  SELECT 'postgres' AS source, 'customers_db' AS db, 0 AS n, o_orderkey, o_totalprice, o_orderpriority AS p,
         CAST(o_orderdate AS TIMESTAMP) AS t FROM orders
  UNION ALL
  SELECT 'sqlserver', 'CRM_DB', 1, o_orderkey, o_totalprice, lower(o_orderpriority),
         CAST(o_orderdate AS TIMESTAMP) + to_hours(CASE WHEN o_orderstatus = 'F' THEN 12 ELSE -12 END) FROM orders
)
SELECT CAST(epoch(t) AS BIGINT) * 4 + n AS kafka_offset, t AS kafka_timestamp, 'SNAPSHOT' AS event_type, source,
       'order' AS entity, strftime(t, {ISO}) AS event_timestamp, 'orders' AS source_table, db AS source_database,
       o_orderkey AS p_order, o_totalprice AS p_total, p AS p_priority, t AS p_updated_at
FROM rows
"""


def dead_letters_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain prose and empty values on the topic among good events: only the good ones decode."""
    def stray(df: DataFrame, number, text) -> DataFrame:
        return df.select(
            F.lit(None).cast("binary").alias("key"), F.encode(text, "UTF-8").alias("value"),
            F.lit("canonical.activity").alias("topic"), F.lit(0).alias("partition"), number.alias("offset"),
            F.lit(None).cast("timestamp").alias("timestamp"))

    docs = stray(table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text"))
    # A tombstone of the log: a record without a value.
    empty = stray(table(spark, sf_dir, "labels"), F.col("doc_id"), F.lit(None).cast("string"))
    good = entity_log(spark, sf_dir, "activity")
    decoded = decode_events(good.unionByName(docs).unionByName(empty), keep_raw=True)
    return dead_letters(decoded).select(
        "topic", "kafka_offset", "reason", F.length("value").cast("bigint").alias("n_bytes"))


DEAD_SQL = """
SELECT 'canonical.activity' AS topic, doc_id AS kafka_offset, 'malformed' AS reason,
       CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes FROM documents
UNION ALL
SELECT 'canonical.activity', doc_id, 'empty', NULL FROM labels
"""


def event_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys by the naming rule: sources that follow none of the names publish without a key."""
    parts = []
    for entity, sources in SOURCES.items():
        for source in sources:
            rows = source_rows(spark, sf_dir, entity, source)
            parts.append(rows.select(
                F.lit(entity).alias("entity"), F.lit(source).alias("source"), event_key(rows, entity).alias("k")))
    per_key = reduce(DataFrame.unionByName, parts).groupBy("entity", "source", "k").agg(F.count("*").alias("n"))
    return per_key.groupBy("entity", "source").agg(
        F.sum("n").alias("n_rows"), F.count("k").alias("n_keys"), F.min("k").alias("low_key"), F.max("k").alias("high_key"))


KEY_SQL = """
WITH k AS (
  SELECT 'customer' AS entity, 'postgres' AS source, CAST(c_custkey AS VARCHAR) AS k FROM customer
  UNION ALL SELECT 'customer', 'sqlserver', NULL FROM customer
  UNION ALL SELECT 'customer', 'teradata', NULL FROM customer
  UNION ALL SELECT 'order', 'postgres', CAST(o_orderkey AS VARCHAR) FROM orders
  UNION ALL SELECT 'order', 'sqlserver', NULL FROM orders
  UNION ALL SELECT 'product', 'postgres', CAST(p_partkey AS VARCHAR) FROM part
  UNION ALL SELECT 'product', 'sqlserver', NULL FROM part
  UNION ALL SELECT 'order_item', 'sqlserver', NULL FROM lineitem
  UNION ALL SELECT 'activity', 'postgres', NULL FROM events
)
SELECT entity, source, count(*) AS n_rows, count(DISTINCT k) AS n_keys, min(k) AS low_key, max(k) AS high_key
FROM k GROUP BY ALL
"""


def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = [as_log(source_events(spark, sf_dir, e, s)) for e, sources in SOURCES.items() for s in sources]
    return decode_events(reduce(DataFrame.unionByName, logs))


def topic_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = [as_log(source_events(spark, sf_dir, e, s)) for e, sources in SOURCES.items() for s in sources]
    routed = reduce(DataFrame.unionByName, logs).groupBy("topic").agg(F.count("*").alias("n_events"))
    return routed.select("topic", (topic_name(F.substring_index("topic", ".", -1)) == F.col("topic")).alias("by_rule"), "n_events")


ROUTING_SQL = """
SELECT 'canonical.customer' AS topic, TRUE AS by_rule, 3 * count(*) AS n_events FROM customer
UNION ALL SELECT 'canonical.order', TRUE, 2 * count(*) FROM orders
UNION ALL SELECT 'canonical.product', TRUE, 2 * count(*) FROM part
UNION ALL SELECT 'canonical.order_item', TRUE, count(*) FROM lineitem
UNION ALL SELECT 'canonical.activity', TRUE, count(*) FROM events
"""


def event_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_counts(all_events(spark, sf_dir))


COUNTS_SQL = """
SELECT 'customer' AS entity, s AS source, 'SNAPSHOT' AS event_type, count(*) AS n_events
FROM customer, (VALUES ('postgres'), ('sqlserver'), ('teradata')) v(s) GROUP BY s
UNION ALL SELECT 'order', s, 'SNAPSHOT', count(*) FROM orders, (VALUES ('postgres'), ('sqlserver')) v(s) GROUP BY s
UNION ALL SELECT 'product', s, 'SNAPSHOT', count(*) FROM part, (VALUES ('postgres'), ('sqlserver')) v(s) GROUP BY s
UNION ALL SELECT 'order_item', 'sqlserver', 'SNAPSHOT', count(*) FROM lineitem
UNION ALL SELECT 'activity', 'postgres', 'SNAPSHOT', count(*) FROM events
"""

QUERIES = {
    "encode_events": encode_events,
    "decode_envelope": decode_envelope,
    "dead_letters": dead_letters_query,
    "event_key": event_key_query,
    "topic_routing": topic_routing,
    "event_counts": event_counts_query,
}
ORACLES = {
    "encode_events": ENCODE_SQL,
    "decode_envelope": DECODE_SQL,
    "dead_letters": DEAD_SQL,
    "event_key": KEY_SQL,
    "topic_routing": ROUTING_SQL,
    "event_counts": COUNTS_SQL,
}
