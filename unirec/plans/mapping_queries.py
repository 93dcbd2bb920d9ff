"""Queries of the field mapping: whole entities, and every mapping rule on its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from unirec.operators.mapping import apply_canonical_mapping, canonicalise
from unirec.plans.derived import INGEST_DATE, SPECS, entity_log, spread, table
from unirec.plans.sql import CUSTOMER_ROWS, ISO, ORDER_ROWS, canonical
from unirec.sources.envelope import decode_events
from unirec.spec import EntitySpec


def canonical_entity(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    decoded = decode_events(entity_log(spark, sf_dir, entity))
    return canonicalise(decoded, SPECS[entity], ingest_date=INGEST_DATE)


def canonical_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_entity(spark, sf_dir, "customer").drop("_partition", "_offset")


def canonical_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_entity(spark, sf_dir, "order").drop("_partition", "_offset")


def canonical_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_entity(spark, sf_dir, "product").drop("_partition", "_offset")


def canonical_order_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_entity(spark, sf_dir, "order_item").drop("_partition", "_offset")


def canonical_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = canonical_entity(spark, sf_dir, "activity").drop("_partition", "_offset")
    return rows.withColumn("props_k", F.get_json_object("props", "$.k").cast("bigint")).drop("props")


PRODUCT_SQL = f"""
WITH rows AS (
  SELECT p_partkey AS product_id, upper(p_name) AS name, p_brand AS brand, p_type AS type,
         CAST(p_size AS BIGINT) AS size, CAST(p_retailprice AS VARCHAR) AS price, 'postgres' AS _source FROM part
  UNION ALL
  SELECT p_partkey, upper(p_name), p_brand, upper(p_type), p_size, CAST(p_retailprice AS VARCHAR), 'sqlserver' FROM part
)
SELECT *, 'SNAPSHOT' AS _event_type, strftime(TIMESTAMP '2024-01-01', {ISO}) AS _event_timestamp,
       DATE '2024-02-01' AS _ingest_date, TRUE AS _is_golden FROM rows
"""
ITEM_ROWS = """
item_rows AS (
  SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_no, l_partkey AS product_id,
         l_suppkey AS supplier_id, CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS price,
         l_discount AS discount, lower(l_returnflag) AS flag, CAST(l_shipdate AS TIMESTAMP) AS updated_at,
         'sqlserver' AS _source
  FROM lineitem
)"""
ACTIVITY_ROWS = """
activity_rows AS (
  SELECT user_id, event_id, upper(event_type) AS kind, value AS amount, CAST(ts AS TIMESTAMP) AS updated_at,
         'postgres' AS _source, CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k
  FROM events
)"""


# --- one rule at a time ------------------------------------------------------------------------


def rule_spec(fields: list[tuple[str, str]], mappings: list[tuple]) -> EntitySpec:
    return EntitySpec.from_document("rule", {
        "canonical_schema": [{"name": n, "data_type": t} for n, t in fields],
        "pg_mappings": [{"source_field": s, "canonical_field": c, "transform": t} for s, c, t in mappings],
        "merge_keys": [fields[0][0]],
    })


def quoted(value: Column) -> Column:
    """A string as JSON text."""
    return F.concat(F.lit('"'), value, F.lit('"'))


def json_object(*members: tuple[Column | str, Column]) -> Column:
    """JSON text from names and JSON values; members keep their order and may repeat."""
    parts = []
    for name, value in members:
        parts.append(F.concat(quoted(F.lit(name) if isinstance(name, str) else name), F.lit(":"), value))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def map_rows(df: DataFrame, payload: Column, spec: EntitySpec, mode: str = "strict", keep: Column | None = None) -> DataFrame:
    rows = spread(df).select(
        payload.alias("payload"), F.lit("postgres").alias("source"), *([] if keep is None else [keep.alias("row_key")]))
    mapped = apply_canonical_mapping(rows, spec, mode)
    extra = [F.array_join("_errors", ",").alias("errors")] if mode == "lenient" else []
    return mapped.select(*([] if keep is None else ["row_key"]), "canonical.*", *extra)


def map_upper_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text, number, booleans, null and empty text, by order priority: falsy values stay as they are."""
    priority = F.col("o_orderpriority")
    value = (
        F.when(priority == "1-URGENT", quoted(F.concat(F.lit("Ab"), F.col("o_orderstatus"), F.lit("z"))))
        .when(priority == "2-HIGH", F.col("o_custkey").cast("string"))
        .when(priority == "3-MEDIUM", F.when(F.col("o_totalprice") > 250000, "true").otherwise("false"))
        .when(priority == "4-NOT SPECIFIED", F.lit("null"))
        .otherwise(F.lit('""'))
    )
    spec = rule_spec([("id", "integer"), ("up", "string"), ("low", "string")], [
        ("id", "id", None), ("u", "up", "UPPER"), ("l", "low", "to LOWER")])
    payload = json_object(("id", F.col("o_orderkey").cast("string")), ("u", value), ("l", value))
    return map_rows(table(spark, sf_dir, "orders"), payload, spec)


UPPER_LOWER_SQL = """
SELECT o_orderkey AS id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'AB' || o_orderstatus || 'Z' WHEN '2-HIGH' THEN CAST(o_custkey AS VARCHAR)
    WHEN '3-MEDIUM' THEN CASE WHEN o_totalprice > 250000 THEN 'TRUE' ELSE 'false' END
    WHEN '4-NOT SPECIFIED' THEN NULL ELSE '' END AS up,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'ab' || lower(o_orderstatus) || 'z' WHEN '2-HIGH' THEN CAST(o_custkey AS VARCHAR)
    WHEN '3-MEDIUM' THEN CASE WHEN o_totalprice > 250000 THEN 'true' ELSE 'false' END
    WHEN '4-NOT SPECIFIED' THEN NULL ELSE '' END AS low
FROM orders
"""


def map_cast_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers are truncated, padded digits are read, text with a fraction empties the whole record."""
    number = F.col("l_extendedprice").cast("string")
    whole = F.col("l_quantity").cast("bigint").cast("string")
    value = (
        F.when(F.col("l_returnflag") == "R", number)
        .when(F.col("l_returnflag") == "A", quoted(F.concat(F.lit(" "), whole, F.lit("  "))))
        .when(F.col("l_linestatus") == "F", quoted(number))
        .otherwise(F.when(F.col("l_discount") > 0.05, "true").otherwise("null"))
    )
    spec = rule_spec([("line", "integer"), ("n", "integer")], [("line", "line", None), ("v", "n", "CAST AS INT")])
    payload = json_object(("line", F.col("l_linenumber").cast("string")), ("v", value))
    key = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey")
    return map_rows(table(spark, sf_dir, "lineitem"), payload, spec, keep=key)


CAST_INT_SQL = """
SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey) AS row_key,
  CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS line,
  CASE WHEN l_returnflag = 'R' THEN CAST(trunc(l_extendedprice) AS BIGINT)
       WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT)
       WHEN l_linestatus = 'F' THEN NULL
       WHEN l_discount > 0.05 THEN 1 END AS n
FROM lineitem
"""


def map_cast_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("o_totalprice").cast("string")
    value = (
        F.when(F.col("o_orderstatus") == "F", quoted(F.concat(F.lit(" "), text)))
        .when(F.col("o_orderstatus") == "O", text)
        .when(F.col("o_orderpriority") == "5-LOW", quoted(F.concat(text, F.lit(" EUR"))))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("true"))
        .otherwise(F.lit("null"))
    )
    spec = rule_spec([("id", "integer"), ("x", "float")], [("id", "id", None), ("v", "x", "cast as float")])
    payload = json_object(("id", F.col("o_orderkey").cast("string")), ("v", value))
    return map_rows(table(spark, sf_dir, "orders"), payload, spec, keep=F.col("o_orderkey"))


CAST_FLOAT_SQL = """
SELECT o_orderkey AS row_key,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END AS id,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN o_totalprice
       WHEN o_orderpriority = '2-HIGH' THEN 1.0 END AS x
FROM orders
"""


def map_key_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mapping, five spellings of its key."""
    segment = F.col("c_mktsegment")
    name = (
        F.when(segment == "FURNITURE", "CustKey").when(segment == "HOUSEHOLD", "custkey")
        .when(segment == "MACHINERY", "CUSTKEY").when(segment == "BUILDING", "cUSTkEY").otherwise("Cust_Key")
    )
    spec = rule_spec([("k", "integer"), ("name", "string")], [("CustKey", "k", None), ("Name", "name", None)])
    payload = json_object((name, F.col("c_custkey").cast("string")), ("NAME", quoted(F.col("c_name"))))
    return map_rows(table(spark, sf_dir, "customer"), payload, spec)


KEY_CASE_SQL = """
SELECT CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE c_custkey END AS k, c_name AS name FROM customer
"""


def map_duplicate_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two payload keys on one field: the last one wins, null included."""
    a, b = F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")
    members = (
        F.when(F.col("o_orderstatus") == "F", json_object(("a", a), ("A", b)))
        .when(F.col("o_orderstatus") == "O", json_object(("A", b), ("a", a)))
        .otherwise(json_object(("a", a), ("alias", F.lit("null"))))
    )
    spec = rule_spec([("x", "integer")], [("a", "x", None), ("alias", "x", None)])
    return map_rows(table(spark, sf_dir, "orders"), members, spec, keep=F.col("o_orderkey"))


DUPLICATE_SQL = """
SELECT o_orderkey AS row_key, CASE o_orderstatus WHEN 'F' THEN o_orderkey WHEN 'O' THEN o_custkey END AS x FROM orders
"""


def map_unknown_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown keys are dropped, fields without a key are null, unknown types are text."""
    spec = rule_spec(
        [("id", "integer"), ("name", "string"), ("balance", "money"), ("phone", "string")],
        [("s_suppkey", "id", None), ("s_name", "name", "TRIM"), ("s_acctbal", "balance", None), ("s_phone", "phone", None)])
    df = table(spark, sf_dir, "supplier")
    return map_rows(df, F.to_json(F.struct(*df.columns)), spec)


UNKNOWN_SQL = """
SELECT s_suppkey AS id, s_name AS name, CAST(s_acctbal AS VARCHAR) AS balance, CAST(NULL AS VARCHAR) AS phone FROM supplier
"""


def _mixed_quality(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """Sizes and prices of which some are not numbers."""
    size = F.col("p_size").cast("string")
    price = F.col("p_retailprice").cast("string")
    payload = json_object(
        ("id", F.col("p_partkey").cast("string")),
        ("size", F.when(F.col("p_type") == "SMALL", quoted(F.concat(size, F.lit(".5")))).otherwise(quoted(size))),
        ("price", F.when(F.col("p_type") == "PROMO", quoted(F.lit("on request"))).otherwise(quoted(price))),
        ("bulk", F.when(F.col("p_type") == "LARGE", F.lit('"true"')).otherwise(F.lit("false"))),
    )
    spec = rule_spec(
        [("id", "integer"), ("size", "integer"), ("price", "float"), ("bulk", "boolean")],
        [("id", "id", None), ("size", "size", "CAST AS INT"), ("price", "price", None), ("bulk", "bulk", None)])
    return map_rows(table(spark, sf_dir, "part"), payload, spec, mode, keep=F.col("p_partkey"))


def map_strict_bad_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed_quality(spark, sf_dir, "strict")


STRICT_SQL = """
SELECT p_partkey AS row_key, CASE WHEN p_type <> 'SMALL' THEN p_partkey END AS id,
  CASE WHEN p_type <> 'SMALL' THEN CAST(p_size AS BIGINT) END AS size, CAST(NULL AS DOUBLE) AS price,
  CASE WHEN p_type NOT IN ('SMALL', 'LARGE') THEN FALSE END AS bulk
FROM part
"""


def map_lenient_bad_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed_quality(spark, sf_dir, "lenient")


LENIENT_SQL = """
SELECT p_partkey AS row_key, p_partkey AS id, CASE WHEN p_type <> 'SMALL' THEN CAST(p_size AS BIGINT) END AS size,
  CASE WHEN p_type <> 'PROMO' THEN p_retailprice END AS price, p_type = 'LARGE' AS bulk,
  CASE p_type WHEN 'SMALL' THEN 'size' WHEN 'PROMO' THEN 'price' ELSE '' END AS errors
FROM part
"""


def typed_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared types, each from a value of its own kind and from one of another kind."""
    ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    payload = json_object(
        ("i", F.col("event_id").cast("string")), ("i_text", quoted(F.col("event_id").cast("string"))),
        ("f", F.col("value").cast("string")), ("f_text", quoted(F.col("value").cast("string"))),
        ("b", F.when(F.col("event_type") == "error", "true").otherwise("false")), ("b_number", F.lit("1")),
        ("d", quoted(F.date_format("ts", "yyyy-MM-dd"))), ("d_number", F.col("user_id").cast("string")),
        ("t", quoted(ts)), ("t_epoch", F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")),
        ("s", quoted(F.col("event_type"))), ("s_number", F.col("user_id").cast("string")),
    )
    kinds = {"i": "integer", "f": "float", "b": "boolean", "d": "date", "t": "timestamp", "s": "string"}
    names = ["i", "i_text", "f", "f_text", "b", "b_number", "d", "d_number", "t", "t_epoch", "s", "s_number"]
    spec = rule_spec([(n, kinds[n[0]]) for n in names], [(n, n, None) for n in names])
    return map_rows(table(spark, sf_dir, "events"), payload, spec)


TYPED_SQL = """
SELECT event_id AS i, CAST(NULL AS BIGINT) AS i_text, value AS f, CAST(NULL AS DOUBLE) AS f_text,
  event_type = 'error' AS b, CAST(NULL AS BOOLEAN) AS b_number, CAST(ts AS DATE) AS d, CAST(NULL AS DATE) AS d_number,
  CAST(ts AS TIMESTAMP) AS t, CAST(date_trunc('second', ts) AS TIMESTAMP) AS t_epoch, event_type AS s,
  CAST(user_id AS VARCHAR) AS s_number
FROM events
"""

def map_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of 18 digits as JSON numbers and as text, in both modes: totals that doubles would miss."""
    orders = table(spark, sf_dir, "orders")
    cents = F.lpad(F.pmod("o_custkey", F.lit(100)).cast("string"), 2, "0")
    amount = F.concat(F.lit("90071992"), F.lpad(F.pmod("o_orderkey", F.lit(100_000_000)).cast("string"), 8, "0"), F.lit("."), cents)
    shape = F.when(F.col("o_orderstatus") == "F", amount).otherwise(quoted(amount))
    spec = rule_spec([("id", "integer"), ("amount", "decimal(18,2)"), ("rounded", "decimal(17,1)")], [
        ("id", "id", None), ("a", "amount", None), ("r", "rounded", "CAST AS FLOAT")])
    payload = json_object(("id", F.col("o_orderkey").cast("string")), (F.when(F.col("o_orderstatus") == "O", "A").otherwise("a"), shape), ("r", amount))
    totals = [F.sum(c).cast("string").alias(c) for c in ("amount", "rounded")]
    strict, lenient = (map_rows(orders, payload, spec, mode).agg(F.count("amount").alias("n"), *totals) for mode in ("strict", "lenient"))
    return strict.withColumn("mode", F.lit("strict")).unionByName(lenient.withColumn("mode", F.lit("lenient")))


DECIMAL_SQL = """
WITH a AS (SELECT CAST('90071992' || lpad(CAST(o_orderkey % 100000000 AS VARCHAR), 8, '0') || '.' || lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0')
    AS DECIMAL(18, 2)) AS amount FROM orders)
SELECT mode, count(*) AS n, CAST(sum(amount) AS VARCHAR) AS amount, CAST(sum(CAST(round(amount, 1) AS DECIMAL(17, 1))) AS VARCHAR) AS rounded
FROM a, (VALUES ('strict'), ('lenient')) m(mode) GROUP BY mode"""

QUERIES = {
    "map_decimal": map_decimal,
    "canonical_customer": canonical_customer,
    "canonical_order": canonical_order,
    "canonical_product": canonical_product,
    "canonical_order_item": canonical_order_item,
    "canonical_activity": canonical_activity,
    "map_upper_lower": map_upper_lower,
    "map_cast_int": map_cast_int,
    "map_cast_float": map_cast_float,
    "map_key_case": map_key_case,
    "map_duplicate_target": map_duplicate_target,
    "map_unknown_field": map_unknown_field,
    "map_strict_bad_record": map_strict_bad_record,
    "map_lenient_bad_field": map_lenient_bad_field,
    "typed_expand": typed_expand,
}
ORACLES = {
    "map_decimal": DECIMAL_SQL,
    "canonical_customer": f"WITH {CUSTOMER_ROWS} {canonical('customer_rows')}",
    "canonical_order": f"WITH {ORDER_ROWS} {canonical('order_rows')}",
    "canonical_product": PRODUCT_SQL,
    "canonical_order_item": f"WITH {ITEM_ROWS} {canonical('item_rows')}",
    "canonical_activity": f"WITH {ACTIVITY_ROWS} {canonical('activity_rows')}",
    "map_upper_lower": UPPER_LOWER_SQL,
    "map_cast_int": CAST_INT_SQL,
    "map_cast_float": CAST_FLOAT_SQL,
    "map_key_case": KEY_CASE_SQL,
    "map_duplicate_target": DUPLICATE_SQL,
    "map_unknown_field": UNKNOWN_SQL,
    "map_strict_bad_record": STRICT_SQL,
    "map_lenient_bad_field": LENIENT_SQL,
    "typed_expand": TYPED_SQL,
}
