"""Queries of latest-per-key, upsert and snapshot difference."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unirec.functions.shared import new_folder
from unirec.operators.diff import snapshot_diff
from unirec.operators.latest import latest_per_key, latest_per_key_agg
from unirec.operators.mapping import canonicalise
from unirec.operators.upsert import split_null_keys, upsert
from unirec.plans.derived import (
    CUSTOMER, INGEST_DATE, ORDER_ITEM, as_log, source_events, source_rows, table,
)
from unirec.plans.mapping_queries import ACTIVITY_ROWS, ITEM_ROWS, canonical_entity
from unirec.plans.sql import CUSTOMER_ROWS, canonical, latest
from unirec.sinks.golden import GoldenTable
from unirec.sources.envelope import decode_events
from unirec.sources.scan import incremental_scan

# Watermark between the early and the late half of the customers' event times.
MARK = datetime(2024, 1, 16)
MARK_SQL = "TIMESTAMP '2024-01-16'"
POSITION = ("_partition", "_offset")


def customer_batch(
    spark: SparkSession, sf_dir: str, source: str, event_type: str = "SNAPSHOT", rows: DataFrame | None = None,
) -> DataFrame:
    log = as_log(source_events(spark, sf_dir, "customer", source, event_type, rows))
    return canonicalise(decode_events(log), CUSTOMER, ingest_date=INGEST_DATE)


def late_rows(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """What a poll of the source finds above the watermark."""
    return incremental_scan(source_rows(spark, sf_dir, "customer", source), "updated_at", MARK)


def early_rows(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return source_rows(spark, sf_dir, "customer", source).filter(F.col("updated_at") <= F.lit(MARK))


# --- latest per key ---------------------------------------------------------------------------


def latest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(canonical_entity(spark, sf_dir, "customer"), ["customer_id"]).drop(*POSITION)


def latest_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key_agg(canonical_entity(spark, sf_dir, "customer"), ["customer_id"]).drop(*POSITION)


def latest_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key of two columns with real repeats; ties in time are broken by the remaining columns."""
    rows = canonical_entity(spark, sf_dir, "order_item").drop(*POSITION)
    order = [F.col(c) for c in ("updated_at", "product_id", "supplier_id", "quantity", "price", "discount", "flag")]
    return latest_per_key(rows, ORDER_ITEM.keys(), order)


def latest_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few keys hold all rows: the newest event of every kind."""
    rows = canonical_entity(spark, sf_dir, "activity").drop(*POSITION, "props")
    return latest_per_key(rows, ["kind"], [F.col("updated_at"), F.col("event_id")])


# --- upsert -----------------------------------------------------------------------------------


def upsert_insert_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the early rows of one source.  Batch: the late rows of another."""
    target = upsert(None, customer_batch(spark, sf_dir, "postgres", rows=early_rows(spark, sf_dir, "postgres")), ["customer_id"])
    batch = customer_batch(spark, sf_dir, "sqlserver", "INSERT", late_rows(spark, sf_dir, "sqlserver"))
    return upsert(target, batch, ["customer_id"]).drop(*POSITION)


def upsert_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches in arrival order: a later batch wins whatever its event time."""
    merged = None
    for source in ("sqlserver", "teradata", "postgres"):
        merged = upsert(merged, customer_batch(spark, sf_dir, source, rows=_wanted(spark, sf_dir, source)), ["customer_id"])
    return merged.drop(*POSITION)


def upsert_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same three batches, each row guarded by its event time."""
    merged = None
    for source in ("sqlserver", "teradata", "postgres"):
        batch = customer_batch(spark, sf_dir, source, rows=_wanted(spark, sf_dir, source))
        merged = upsert(merged, batch, ["customer_id"], mode="event_time")
    return merged.drop(*POSITION)


def _wanted(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """The last batch is an increment, so that some keys keep an earlier batch's row."""
    return late_rows(spark, sf_dir, source) if source == "postgres" else source_rows(spark, sf_dir, "customer", source)


def upsert_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids written as text do not read as integers: those rows go to quarantine."""
    rows = source_rows(spark, sf_dir, "customer", "sqlserver")
    broken = rows.withColumns({
        "Id": F.when(F.col("Segment") == "building", F.lit(None)).otherwise(F.col("Id")),
    })
    batch = customer_batch(spark, sf_dir, "sqlserver", rows=broken)
    usable, nulls = split_null_keys(batch, ["customer_id"])
    merged = upsert(None, usable, ["customer_id"])
    tagged = merged.withColumn("place", F.lit("table")).unionByName(nulls.withColumn("place", F.lit("quarantine")))
    return tagged.select("customer_id", "name", "segment", "balance", "place")


def _deletes(spark: SparkSession, sf_dir: str, policy: str, mode: str = "event_time") -> DataFrame:
    """Snapshot of one source, then deletes of its customers in debt as seen by another."""
    target = upsert(None, customer_batch(spark, sf_dir, "postgres"), ["customer_id"], delete_policy=policy_store(policy))
    gone = source_rows(spark, sf_dir, "customer", "sqlserver").filter(F.col("Balance").cast("double") < 0)
    batch = customer_batch(spark, sf_dir, "sqlserver", "DELETE", gone)
    return upsert(target, batch, ["customer_id"], mode=mode, delete_policy=policy).drop(*POSITION)


def policy_store(policy: str) -> str:
    """A table that removes on read still stores its tombstones."""
    return "tombstone" if policy == "remove" else policy


def upsert_delete_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deletes(spark, sf_dir, "keep", "arrival")


def upsert_delete_tombstone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deletes(spark, sf_dir, "tombstone")


def upsert_delete_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deletes(spark, sf_dir, "remove")


DELETE_ROWS = f"""
WITH {CUSTOMER_ROWS},
snap AS ({canonical("customer_rows WHERE _source = 'postgres'")}),
gone AS ({canonical("customer_rows WHERE _source = 'sqlserver' AND balance < 0", "'DELETE'")}),
both_rows AS (SELECT *, 0 AS batch FROM snap UNION ALL SELECT *, 1 FROM gone)"""


def golden_table_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored form: three batches, one of them written twice, with a compaction in between."""
    batches = [customer_batch(spark, sf_dir, s, rows=_wanted(spark, sf_dir, s)) for s in ("sqlserver", "teradata", "postgres")]
    golden = GoldenTable(spark, new_folder(spark, "golden"), batches[0].schema, ["customer_id"], mode="event_time")
    golden.write_batch(batches[0], 0)
    golden.write_batch(batches[1], 1)
    golden.compact()
    golden.write_batch(batches[2], 2)
    golden.write_batch(batches[2], 2)
    return golden.read().drop(*POSITION)


# --- difference -------------------------------------------------------------------------------


def order_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two states of the orders: old ones leave, new ones come, urgent ones change their status."""
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    old = orders.filter(F.col("o_orderdate") < F.lit(datetime(2001, 1, 1)))
    status = F.when(F.col("o_orderpriority") == "1-URGENT", "F").otherwise(F.col("o_orderstatus"))
    new = orders.filter(F.col("o_orderdate") >= F.lit(datetime(1996, 1, 1))).withColumn("o_orderstatus", status)
    diff = snapshot_diff(old, new, ["o_orderkey"])
    return diff.withColumn("before_status", F.col("before.o_orderstatus")).drop("before")


DIFF_SQL = """
WITH old AS (SELECT * REPLACE (CAST(o_orderdate AS TIMESTAMP) AS o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'),
new AS (
  SELECT * REPLACE (CAST(o_orderdate AS TIMESTAMP) AS o_orderdate,
                    CASE WHEN o_orderpriority = '1-URGENT' THEN 'F' ELSE o_orderstatus END AS o_orderstatus)
  FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
SELECT 'INSERT' AS event_type, n.*, NULL AS before_status FROM new n WHERE n.o_orderkey NOT IN (SELECT o_orderkey FROM old)
UNION ALL
SELECT 'DELETE', o.*, o.o_orderstatus FROM old o WHERE o.o_orderkey NOT IN (SELECT o_orderkey FROM new)
UNION ALL
SELECT 'UPDATE', n.*, o.o_orderstatus FROM new n JOIN old o USING (o_orderkey) WHERE n.o_orderstatus <> o.o_orderstatus
"""

THREE_BATCHES = f"""
WITH {CUSTOMER_ROWS}, batches AS (
  SELECT *, CASE _source WHEN 'sqlserver' THEN 0 WHEN 'teradata' THEN 1 ELSE 2 END AS batch
  FROM ({canonical('customer_rows')}) WHERE _source <> 'postgres' OR updated_at > {MARK_SQL})"""
EVENT_TIME_SQL = f"{THREE_BATCHES} SELECT * EXCLUDE (batch) FROM ({latest('batches', 'customer_id', 'updated_at DESC')})"

QUERIES = {
    "latest_per_key_window": latest_window,
    "latest_per_key_agg": latest_agg,
    "latest_per_key_composite": latest_composite,
    "latest_per_key_hot": latest_hot_key,
    "upsert_insert_update": upsert_insert_update,
    "upsert_two_batches_arrival": upsert_arrival,
    "upsert_event_time_guard": upsert_event_time,
    "upsert_null_keys_quarantine": upsert_quarantine,
    "upsert_delete_keep": upsert_delete_keep,
    "upsert_delete_tombstone": upsert_delete_tombstone,
    "upsert_delete_remove": upsert_delete_remove,
    "golden_table_batches": golden_table_batches,
    "snapshot_diff": order_snapshot_diff,
}
LATEST_CUSTOMER = f"""WITH {CUSTOMER_ROWS}, c AS ({canonical('customer_rows')})
{latest('c', 'customer_id', 'updated_at DESC')}"""
ORACLES = {
    "latest_per_key_window": LATEST_CUSTOMER,
    "latest_per_key_agg": LATEST_CUSTOMER,
    "latest_per_key_composite": f"""WITH {ITEM_ROWS}, c AS ({canonical('item_rows')})
{latest('c', 'order_id, line_no', 'updated_at DESC, product_id DESC, supplier_id DESC, quantity DESC, price DESC, discount DESC, flag DESC')}""",
    "latest_per_key_hot": f"""WITH {ACTIVITY_ROWS}, c AS ({canonical('activity_rows')})
SELECT * EXCLUDE (props_k) FROM ({latest('c', 'kind', 'updated_at DESC, event_id DESC')})""",
    "upsert_insert_update": f"""WITH {CUSTOMER_ROWS},
early AS ({canonical(f"customer_rows WHERE _source = 'postgres' AND updated_at <= {MARK_SQL}")}),
late AS ({canonical(f"customer_rows WHERE _source = 'sqlserver' AND updated_at > {MARK_SQL}", "'INSERT'")})
SELECT * FROM late UNION ALL SELECT * FROM early WHERE customer_id NOT IN (SELECT customer_id FROM late)""",
    "upsert_two_batches_arrival": f"""{THREE_BATCHES}
SELECT * EXCLUDE (batch) FROM ({latest('batches', 'customer_id', 'batch DESC')})""",
    "upsert_event_time_guard": EVENT_TIME_SQL,
    "upsert_null_keys_quarantine": """
SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS customer_id, upper(c_name) AS name,
  upper(c_mktsegment) AS segment, c_acctbal AS balance,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN 'table' ELSE 'quarantine' END AS place
FROM customer""",
    "upsert_delete_keep": f"""{DELETE_ROWS}
SELECT * EXCLUDE (batch) FROM ({latest('both_rows', 'customer_id', 'batch DESC')})""",
    "upsert_delete_tombstone": f"""{DELETE_ROWS}
SELECT * EXCLUDE (batch), _event_type = 'DELETE' AS _deleted FROM ({latest('both_rows', 'customer_id', 'updated_at DESC')})""",
    "upsert_delete_remove": f"""{DELETE_ROWS}
SELECT * EXCLUDE (batch) FROM ({latest('both_rows', 'customer_id', 'updated_at DESC')}) WHERE _event_type <> 'DELETE'""",
    "golden_table_batches": EVENT_TIME_SQL,
    "snapshot_diff": DIFF_SQL,
}
