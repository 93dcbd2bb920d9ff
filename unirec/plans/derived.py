"""Source tables derived from the driver's tables, and the canonical specs that unite them.

Every derived table covers its whole base table.  The three customer sources hold every customer; which
of them wrote last differs from key to key, so each of them wins some keys.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from unirec.sources.envelope import encode_events, serialise, with_position
from unirec.spec import EntitySpec

INGEST_DATE = date(2024, 2, 1)
# Number of each source, used in the event times so that no two sources write one key at one time.
SOURCE_NUMBER = {"postgres": 0, "sqlserver": 1, "teradata": 2}
DATABASES = {"postgres": "customers_db", "sqlserver": "CRM_DB", "teradata": "warehouse"}


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the files once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


# Rows of which a task of their own is worth its start, and rows that one task encodes at most where the rows are dealt.
LEAST_ROWS, MOST_ROWS = 20_000, 500_000


def encode_tasks(df: DataFrame) -> int | None:
    """Tasks to deal the rows to before they are encoded; None where they stay as they are read.

    A scan is cut by bytes, but a Parquet row group is read by one task, and encoding a row costs far more than reading or
    shuffling it.  So a scan in fewer than two parts for each core is dealt anew, by the number of its rows."""
    tasks = df.sparkSession.conf.get("unirec.encode.tasks", None)
    if tasks:
        return int(tasks)
    wanted = 2 * df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= wanted:
        return None
    rows = df.count()
    tasks = min(max(wanted, rows // MOST_ROWS), rows // LEAST_ROWS)
    return tasks if tasks > 1 else None


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt to ``encode_tasks`` tasks."""
    tasks = encode_tasks(df)
    return df.repartition(tasks) if tasks else df


def at(seconds: Column) -> Column:
    """Seconds after 2024-01-01 as a timestamp."""
    return F.timestamp_seconds(F.lit(1704067200) + seconds)


def customer_time(source: str) -> Column:
    key = F.col("c_custkey")
    return at(F.pmod(key * 7919, F.lit(864000)) * 3 + F.pmod(key + SOURCE_NUMBER[source], F.lit(3)))


def customer_source(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    base = table(spark, sf_dir, "customer")
    ts = customer_time(source)
    if source == "postgres":
        return base.select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation_id"),
            F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"), ts.alias("updated_at"))
    if source == "sqlserver":
        return base.select(
            F.col("c_custkey").alias("Id"), F.col("c_name").alias("FullName"),
            F.col("c_nationkey").alias("NationId"), F.col("c_acctbal").cast("string").alias("Balance"),
            F.lower("c_mktsegment").alias("Segment"), ts.alias("updated_at"))
    return base.select(
        F.col("c_custkey").alias("cust_id"), F.col("c_name").alias("cust_nm"),
        F.col("c_nationkey").alias("nation_id"), F.col("c_mktsegment").alias("segment"), ts.alias("created_ts"))


def order_source(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    base = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("timestamp")
    if source == "postgres":
        return base.select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"),
            F.col("o_orderpriority").alias("priority"), day.alias("updated_at"))
    # This source is half a day ahead for finished orders and half a day behind for the others.
    shift = F.when(F.col("o_orderstatus") == "F", 12).otherwise(-12)
    return base.select(
        F.col("o_orderkey").alias("OrderId"), F.col("o_custkey").alias("CustomerId"),
        F.lower("o_orderstatus").alias("Status"), F.col("o_totalprice").cast("string").alias("Total"),
        F.lower("o_orderpriority").alias("Priority"),
        (day + F.make_dt_interval(hours=shift)).alias("updated_at"))


def product_source(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    base = table(spark, sf_dir, "part")
    columns = {
        "id": F.col("p_partkey"), "name": F.col("p_name"), "brand": F.col("p_brand"), "type": F.col("p_type"),
        "size": F.col("p_size"), "price": F.col("p_retailprice"),
    }
    if source == "sqlserver":
        columns |= {"size": F.concat(F.lit(" "), F.col("p_size").cast("string")), "type": F.lower("p_type")}
        columns = {k.capitalize(): v for k, v in columns.items()}
    return base.select(*[c.alias(n) for n, c in columns.items()])


def order_item_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"), F.col("l_returnflag").alias("flag"),
        F.col("l_shipdate").cast("timestamp").alias("updated_at"))


def activity_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("event_type").alias("kind"), F.col("value").alias("amount"),
        F.try_parse_json("props").alias("props"), F.col("ts").cast("timestamp").alias("updated_at"))


def _mappings(source: str, rows: list[tuple]) -> list[dict]:
    return [{"source": source, "source_field": s, "canonical_field": c, "transform": t} for s, c, t in rows]


def _fields(rows: list[tuple]) -> list[dict]:
    return [{"name": n, "data_type": t, "nullable": nullable} for n, t, nullable in rows]


CUSTOMER = EntitySpec.from_document("customer", {
    "canonical_schema": _fields([
        ("customer_id", "integer", False), ("name", "string", True), ("nation_id", "integer", True),
        ("balance", "float", True), ("segment", "string", True), ("updated_at", "timestamp", True)]),
    "pg_mappings": _mappings("postgres", [
        ("id", "customer_id", None), ("name", "name", "UPPER"), ("nation_id", "nation_id", None),
        ("balance", "balance", None), ("segment", "segment", "UPPER"), ("updated_at", "updated_at", None)]),
    "sql_mappings": _mappings("sqlserver", [
        ("Id", "customer_id", None), ("FullName", "name", "UPPER"), ("NationId", "nation_id", None),
        ("Balance", "balance", "CAST AS FLOAT"), ("Segment", "segment", "UPPER"), ("updated_at", "updated_at", None)]),
    "td_mappings": _mappings("teradata", [
        ("CUST_ID", "customer_id", None), ("CUST_NM", "name", "UPPER"), ("NATION_ID", "nation_id", None),
        ("SEGMENT", "segment", "UPPER"), ("CREATED_TS", "updated_at", None)]),
    "merge_keys": ["customer_id"],
})

ORDER = EntitySpec.from_document("order", {
    "canonical_schema": _fields([
        ("order_id", "integer", False), ("customer_id", "integer", True), ("status", "string", True),
        ("total", "float", True), ("priority", "string", True), ("updated_at", "timestamp", True)]),
    "pg_mappings": _mappings("postgres", [
        ("id", "order_id", None), ("customer_id", "customer_id", None), ("status", "status", None),
        ("total", "total", None), ("priority", "priority", "LOWER"), ("updated_at", "updated_at", None)]),
    "sql_mappings": _mappings("sqlserver", [
        ("OrderId", "order_id", None), ("CustomerId", "customer_id", None), ("Status", "status", "UPPER"),
        ("Total", "total", "CAST AS FLOAT"), ("Priority", "priority", None), ("updated_at", "updated_at", None)]),
    "merge_keys": ["order_id"],
})

PRODUCT = EntitySpec.from_document("product", {
    "canonical_schema": _fields([
        ("product_id", "integer", False), ("name", "string", True), ("brand", "string", True),
        ("type", "string", True), ("size", "integer", True), ("price", "decimal", True)]),
    "pg_mappings": _mappings("postgres", [
        ("id", "product_id", None), ("name", "name", "UPPER"), ("brand", "brand", "TRIM"), ("type", "type", None),
        ("size", "size", None), ("price", "price", None)]),
    "sql_mappings": _mappings("sqlserver", [
        ("Id", "product_id", None), ("Name", "name", "UPPER"), ("Brand", "brand", None), ("Type", "type", "UPPER"),
        ("Size", "size", "CAST AS INTEGER"), ("Price", "price", None)]),
    "merge_keys": ["product_id"],
})

ORDER_ITEM = EntitySpec.from_document("order_item", {
    "canonical_schema": _fields([
        ("order_id", "integer", False), ("line_no", "integer", True), ("product_id", "integer", True),
        ("supplier_id", "integer", True), ("quantity", "integer", True), ("price", "float", True),
        ("discount", "float", True), ("flag", "string", True), ("updated_at", "timestamp", True)]),
    "sql_mappings": _mappings("sqlserver", [
        ("order_id", "order_id", None), ("line_no", "line_no", None), ("product_id", "product_id", None),
        ("supplier_id", "supplier_id", None), ("quantity", "quantity", "CAST AS INT"), ("price", "price", None),
        ("discount", "discount", None), ("flag", "flag", "LOWER"), ("updated_at", "updated_at", None)]),
    "merge_keys": ["order_id", "line_no"],
})

ACTIVITY = EntitySpec.from_document("activity", {
    "canonical_schema": _fields([
        ("user_id", "integer", False), ("event_id", "integer", True), ("kind", "string", True),
        ("amount", "float", True), ("props", "string", True), ("updated_at", "timestamp", True)]),
    "pg_mappings": _mappings("postgres", [
        ("user_id", "user_id", None), ("event_id", "event_id", None), ("kind", "kind", "UPPER"),
        ("amount", "amount", None), ("props", "props", None), ("updated_at", "updated_at", None)]),
    "merge_keys": ["user_id"],
})

SPECS = {s.name: s for s in (CUSTOMER, ORDER, PRODUCT, ORDER_ITEM, ACTIVITY)}

# Entity -> source -> (table name, reader, key column, time column)
SOURCES: dict[str, dict[str, tuple[str, Callable, str, str | None]]] = {
    "customer": {
        "postgres": ("customer", customer_source, "id", "updated_at"),
        "sqlserver": ("customers", customer_source, "Id", "updated_at"),
        "teradata": ("CUSTOMER", customer_source, "cust_id", "created_ts"),
    },
    "order": {
        "postgres": ("orders", order_source, "id", "updated_at"),
        "sqlserver": ("orders", order_source, "OrderId", "updated_at"),
    },
    "product": {
        "postgres": ("products", product_source, "id", None),
        "sqlserver": ("products", product_source, "Id", None),
    },
    "order_item": {
        "sqlserver": ("order_items", lambda spark, sf, _: order_item_source(spark, sf), "order_id", "updated_at"),
    },
    "activity": {
        "postgres": ("events", lambda spark, sf, _: activity_source(spark, sf), "user_id", "updated_at"),
    },
}


def source_rows(spark: SparkSession, sf_dir: str, entity: str, source: str) -> DataFrame:
    return SOURCES[entity][source][1](spark, sf_dir, source)


def source_events(
    spark: SparkSession, sf_dir: str, entity: str, source: str, event_type: str | Column = "SNAPSHOT",
    rows: DataFrame | None = None,
) -> DataFrame:
    """Envelope columns of one source of one entity (of all its rows unless given)."""
    name, _, key, time = SOURCES[entity][source]
    rows = spread(source_rows(spark, sf_dir, entity, source) if rows is None else rows)
    when = F.col(time) if time else F.lit("2024-01-01 00:00:00").cast("timestamp")
    return encode_events(
        rows, source, entity, event_type, table=name, database=DATABASES[source],
        event_time=when, key=F.col(key), payload_columns=rows.columns)


def as_log(events: DataFrame) -> DataFrame:
    """Log rows with a position that is a function of the event alone: time, then source."""
    instant = F.col("timestamp").cast("timestamp")
    number = F.create_map(*[F.lit(x) for pair in SOURCE_NUMBER.items() for x in pair])[F.col("source")]
    placed = events.withColumns({"_offset": F.unix_seconds(instant) * 4 + number, "_instant": instant})
    rows = serialise(placed, keep=("_offset", "_instant"))
    return with_position(rows, 3, F.col("_offset"), F.col("_instant"))


def entity_log(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """All sources of an entity on its topic."""
    logs = [as_log(source_events(spark, sf_dir, entity, s)) for s in SOURCES[entity]]
    merged = logs[0]
    for more in logs[1:]:
        merged = merged.unionByName(more)
    return merged
