"""Queries of discovery: catalogues, inferred types, entity matches, mapping proposals, merge keys."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unirec.functions.shared import stored
from unirec.operators.counts import catalog_summary, pipeline_summary
from unirec.operators.keys import discover_merge_keys
from unirec.operators.match import (
    active_sources, canonical_fields, match_entities, matched_columns, propose_fields, propose_mappings,
)
from unirec.operators.profile import infer_json_columns, infer_json_paths, merge_key_candidates
from unirec.plans.derived import SOURCES, SPECS, entity_log, spread, table
from unirec.plans.event_queries import all_events
from unirec.sources.catalog import row_counts, table_catalog
from unirec.sources.envelope import dead_letters, decode_events, with_position

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)


def given_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in TABLES}


def column_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_catalog(spark, given_tables(spark, sf_dir), "spark", "parquet", "testdata")


def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(given_tables(spark, sf_dir))


def infer_json_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column types of JSON documents over all rows, with mixed and missing values."""
    docs = spread(table(spark, sf_dir, "events")).select("event_type", F.to_json(F.struct(
        F.col("event_id").alias("id"),
        "value",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.when(F.col("event_type") == "error", F.col("user_id").cast("string")).alias("note"),
        (F.col("value") > 10).alias("big"),
        F.try_parse_json("props").alias("props"),
        F.when(F.col("value") > 5, F.to_variant_object(F.array("user_id")))
        .otherwise(F.try_parse_json(F.lit("1.5"))).alias("mixed"),
    ), {"ignoreNullFields": "false"}).alias("doc"))
    return infer_json_columns(docs, "doc")


INFER_SQL = """
SELECT n.name, n.data_type, (SELECT count(*) FROM events) AS n_values,
  CASE WHEN n.name = 'note' THEN (SELECT count(*) FROM events WHERE event_type <> 'error') ELSE 0 END AS n_nulls,
  n.name = 'id' AS is_primary_key, (SELECT count(*) FROM events) AS row_count
FROM (VALUES ('id', 'integer'), ('value', 'float'), ('day', 'date'), ('note', 'string'), ('big', 'boolean'),
             ('props', 'string'), ('mixed', 'string')) n(name, data_type)
"""


def source_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue of the sources as the log shows them: every key that occurs in a table's payloads."""
    events = all_events(spark, sf_dir).withColumnRenamed("source_table", "table")
    # A catalogue is small and used several times by what follows, so it is worked out once.
    return stored(infer_json_columns(events, "payload", ("source", "table")), "catalog")


def infer_source_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_catalog(spark, sf_dir).select("source", "table", "name", "data_type", "row_count")


# Names and types of the derived tables' columns; the rows behind them are counted from the tables.
SOURCE_COLUMNS = """
cols(source, "table", name, data_type) AS (VALUES
  ('postgres','customer','id','integer'), ('postgres','customer','name','string'), ('postgres','customer','nation_id','integer'),
  ('postgres','customer','balance','float'), ('postgres','customer','segment','string'), ('postgres','customer','updated_at','string'),
  ('sqlserver','customers','Id','integer'), ('sqlserver','customers','FullName','string'), ('sqlserver','customers','NationId','integer'),
  ('sqlserver','customers','Balance','string'), ('sqlserver','customers','Segment','string'), ('sqlserver','customers','updated_at','string'),
  ('teradata','CUSTOMER','cust_id','integer'), ('teradata','CUSTOMER','cust_nm','string'), ('teradata','CUSTOMER','nation_id','integer'),
  ('teradata','CUSTOMER','segment','string'), ('teradata','CUSTOMER','created_ts','string'),
  ('postgres','orders','id','integer'), ('postgres','orders','customer_id','integer'), ('postgres','orders','status','string'),
  ('postgres','orders','total','float'), ('postgres','orders','priority','string'), ('postgres','orders','updated_at','string'),
  ('sqlserver','orders','OrderId','integer'), ('sqlserver','orders','CustomerId','integer'), ('sqlserver','orders','Status','string'),
  ('sqlserver','orders','Total','string'), ('sqlserver','orders','Priority','string'), ('sqlserver','orders','updated_at','string'),
  ('postgres','products','id','integer'), ('postgres','products','name','string'), ('postgres','products','brand','string'),
  ('postgres','products','type','string'), ('postgres','products','size','integer'), ('postgres','products','price','float'),
  ('sqlserver','products','Id','integer'), ('sqlserver','products','Name','string'), ('sqlserver','products','Brand','string'),
  ('sqlserver','products','Type','string'), ('sqlserver','products','Size','string'), ('sqlserver','products','Price','float'),
  ('sqlserver','order_items','order_id','integer'), ('sqlserver','order_items','line_no','integer'),
  ('sqlserver','order_items','product_id','integer'), ('sqlserver','order_items','supplier_id','integer'),
  ('sqlserver','order_items','quantity','float'), ('sqlserver','order_items','price','float'),
  ('sqlserver','order_items','discount','float'), ('sqlserver','order_items','flag','string'),
  ('sqlserver','order_items','updated_at','string'),
  ('postgres','events','event_id','integer'), ('postgres','events','user_id','integer'), ('postgres','events','kind','string'),
  ('postgres','events','amount','float'), ('postgres','events','props','string'), ('postgres','events','updated_at','string')
),
counts("table", row_count) AS (
  SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'customers', count(*) FROM customer
  UNION ALL SELECT 'CUSTOMER', count(*) FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
  UNION ALL SELECT 'products', count(*) FROM part UNION ALL SELECT 'order_items', count(*) FROM lineitem
  UNION ALL SELECT 'events', count(*) FROM events
),
catalog AS (SELECT cols.*, row_count FROM cols JOIN counts USING ("table"))"""


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_summary(source_catalog(spark, sf_dir))


def infer_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents made of the events: objects in lists, lists of mixed values, members that only some have."""
    kind, number = F.col("event_type"), F.col("value").cast("string")
    some = F.when(kind == "error", F.concat(F.lit(',"more":[{"code":'), number, F.lit("},7]"))).otherwise(
        F.when(kind == "signup", F.lit(',"more":"2024-02-30"')).otherwise(F.lit("")))
    document = F.concat(
        F.lit('{"user":{"id":'), F.col("user_id").cast("string"), F.lit(',"day":"2024-01-01"},"props":'), F.col("props"),
        F.lit(',"values":['), number, F.lit(',null,{"t":true,"u":[[]]}]'), some, F.lit("}"))
    docs = spread(table(spark, sf_dir, "events")).select("event_type", document.alias("document"))
    return infer_json_paths(docs, "document", ("event_type",))


PATHS_SQL = r"""
WITH d AS (SELECT event_type, '{"user":{"id":' || user_id || ',"day":"2024-01-01"},"props":' || props || ',"values":[' || value || ',null,{"t":true,"u":[[]]}]'
    || CASE event_type WHEN 'error' THEN ',"more":[{"code":' || value || '},7]' WHEN 'signup' THEN ',"more":"2024-02-30"' ELSE '' END || '}' AS j FROM events),
t AS (SELECT event_type, regexp_replace(t.fullkey, '\[[0-9]+\]', '[]', 'g') AS path, CASE t.type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array'
    WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'DOUBLE' THEN 'float' WHEN 'BIGINT' THEN 'integer' WHEN 'UBIGINT' THEN 'integer'
    ELSE CASE WHEN length(t.atom ->> '$') = 10 AND substr(t.atom ->> '$', 5, 1) = '-' THEN 'date' ELSE 'string' END END AS type
  FROM d, json_tree(d.j) t)
SELECT event_type, path, CASE WHEN count(DISTINCT type) FILTER (type <> 'null') = 1 THEN min(type) FILTER (type <> 'null')
    WHEN bool_and(type IN ('integer', 'float', 'null')) AND count(DISTINCT type) FILTER (type <> 'null') = 2 THEN 'float' ELSE 'string' END AS data_type,
  count(*) AS n_values, count(*) FILTER (type = 'null') AS n_nulls, (SELECT count(*) FROM d WHERE d.event_type = t.event_type) AS row_count
FROM t GROUP BY event_type, path"""


def whole_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources, what was matched among them, the models proposed, and a log that holds two kinds of unreadable rows."""
    catalog = source_catalog(spark, sf_dir)
    matches = stored(match_entities(catalog), "matches")
    models = propose_fields(matched_columns(matches, catalog))
    logs = [entity_log(spark, sf_dir, entity) for entity in ("customer", "product")]
    named = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))
    broken = with_position(
        named.select(F.lit(None).cast("binary").alias("key"), F.when(~F.col("name").startswith("A"), F.encode("name", "UTF-8")).alias("value"), F.lit("canonical.nation").alias("topic")),
        3, F.lit(0), F.lit("2024-01-01 00:00:00").cast("timestamp"))
    decoded = decode_events(logs[0].unionByName(logs[1]).unionByName(broken), keep_raw=True)
    return pipeline_summary(catalog, matches, models, decoded, dead_letters(decoded))


def matches_of_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_entities(source_catalog(spark, sf_dir))


def active_sources_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that hold an entity, with the rows they hold of it."""
    catalog = source_catalog(spark, sf_dir)
    counts = catalog.groupBy("source", "table").agg(F.max("row_count").alias("row_count"))
    return active_sources(match_entities(catalog)).join(counts, ["source", "table"])


MATCH_SQL = f"""
WITH {SOURCE_COLUMNS}, named AS (
  SELECT DISTINCT source, "table", CASE lower("table") WHEN 'customers' THEN 'customer' WHEN 'orders' THEN 'order'
    WHEN 'products' THEN 'product' WHEN 'order_items' THEN 'order_item' WHEN 'events' THEN 'event'
    ELSE lower("table") END AS canonical_name, row_count
  FROM catalog)
"""


def fields_proposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = source_catalog(spark, sf_dir)
    return propose_fields(matched_columns(match_entities(catalog), catalog))


def mappings_proposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source columns matched to the fields of the known specs."""
    catalog = source_catalog(spark, sf_dir)
    columns = matched_columns(match_entities(catalog), catalog)
    fields = canonical_fields([SPECS[e] for e in SOURCES], columns)
    return propose_mappings(columns, fields).drop("rule")


SNAKED = "CASE WHEN name IN ('FullName', 'NationId', 'OrderId', 'CustomerId') THEN " \
         "CASE name WHEN 'FullName' THEN 'full_name' WHEN 'NationId' THEN 'nation_id' WHEN 'OrderId' THEN 'order_id' " \
         "ELSE 'customer_id' END ELSE lower(name) END"
FIELDS_SQL = MATCH_SQL + f"""
, fields AS (
  SELECT canonical_name, CASE WHEN lower(name) = 'id' THEN canonical_name || '_id' ELSE {SNAKED} END AS canonical_field, data_type
  FROM catalog JOIN named USING (source, "table"))
SELECT canonical_name, canonical_field,
  CASE WHEN count(DISTINCT data_type) = 1 THEN min(data_type)
       WHEN bool_and(data_type IN ('integer', 'float')) THEN 'float' ELSE 'string' END AS data_type,
  count(*) AS n_columns
FROM fields GROUP BY canonical_name, canonical_field
"""
# What the name rules must find; two names share no signature with a field and are matched by edit distance.
MAPPINGS_SQL = MATCH_SQL + f"""
SELECT canonical_name, source, "table", name AS source_field,
  CASE WHEN lower(name) = 'id' OR name = 'cust_id' THEN canonical_name || '_id'
       WHEN name IN ('cust_nm', 'FullName') THEN 'name' WHEN name = 'created_ts' THEN 'updated_at' ELSE {SNAKED} END AS canonical_field
FROM catalog JOIN named USING (source, "table")
WHERE canonical_name <> 'event'
"""


WHOLE_SUMMARY_SQL = MATCH_SQL + f"""
, fields AS (SELECT DISTINCT canonical_name, CASE WHEN lower(name) = 'id' THEN canonical_name || '_id' ELSE {SNAKED} END AS field
  FROM catalog JOIN named USING (source, "table"))
SELECT source || ' tables' AS item, count(DISTINCT "table") AS n FROM catalog GROUP BY source
UNION ALL SELECT 'entity matches', count(DISTINCT canonical_name) FROM named
UNION ALL SELECT 'canonical models', count(DISTINCT canonical_name) FROM named
UNION ALL SELECT 'canonical fields', count(*) FROM fields
UNION ALL SELECT 'topics', 2
UNION ALL SELECT 'events', (SELECT 3 * count(*) FROM customer) + (SELECT 2 * count(*) FROM part)
UNION ALL SELECT CASE WHEN n_name LIKE 'A%' THEN 'errors: empty' ELSE 'errors: malformed' END, count(*) FROM nation GROUP BY ALL
"""


def merge_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spread(table(spark, sf_dir, "lineitem"))
    by_line = merge_key_candidates(items, [
        ["l_orderkey"], ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"],
        ["l_returnflag"]]).withColumn("table", F.lit("lineitem"))
    customers = table(spark, sf_dir, "customer").withColumn(
        "vip", F.when(F.col("c_acctbal") > 0, F.col("c_custkey")))
    by_customer = merge_key_candidates(customers, [["c_custkey"], ["c_name"], ["c_nationkey"], ["vip"]]).withColumn(
        "table", F.lit("customer"))
    turns = merge_key_candidates(table(spark, sf_dir, "conversations"), [["conv_id"], ["conv_id", "turn"]]).withColumn(
        "table", F.lit("conversations"))
    return by_line.unionByName(by_customer).unionByName(turns)


KEY_COLUMNS = {
    "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity"],
    "orders": ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"],
}


def discover_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All minimal keys of up to three columns.  Every pass reads the columns alone, dealt once."""
    tables = {t: stored(spread(table(spark, sf_dir, t).select(*columns)), "key-columns") for t, columns in KEY_COLUMNS.items()}
    found = [discover_merge_keys(df, KEY_COLUMNS[t]).withColumn("table", F.lit(t)) for t, df in tables.items()]
    return found[0].unionByName(found[1])


def _all_keys_sql() -> str:
    """Every set of up to three columns, counted exactly; a set that holds another key is not minimal."""
    sets = [
        f"""SELECT '{t}' AS "table", '{'+'.join(s)}' AS candidate, [{', '.join(f"'{c}'" for c in s)}] AS names, {len(s)} AS n_columns,
  (SELECT count(*) FROM {t}) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(s)} FROM {t})) AS n_distinct"""
        for t, columns in KEY_COLUMNS.items() for size in (1, 2, 3) for s in combinations(columns, size)]
    return f"""
WITH sets AS ({' UNION ALL '.join(sets)}), keys AS (SELECT * FROM sets WHERE n_rows = n_distinct)
SELECT "table", candidate, CAST(n_columns AS INTEGER) AS n_columns, n_rows FROM keys k
WHERE NOT EXISTS (SELECT 1 FROM keys o WHERE o."table" = k."table" AND o.n_columns < k.n_columns AND list_has_all(k.names, o.names))"""


def _key_sql(name: str, table_name: str, columns: str, rows: str | None = None) -> str:
    nulls = " OR ".join(f"{c} IS NULL" for c in columns.split(", "))
    return f"""
SELECT '{name}' AS candidate, '{table_name}' AS "table", n_rows, n_distinct, n_null, n_null = 0 AND n_rows = n_distinct AS is_key
FROM (SELECT count(*) AS n_rows, count(*) FILTER (WHERE {nulls}) AS n_null FROM {rows or table_name}),
     (SELECT count(*) AS n_distinct FROM (SELECT DISTINCT {columns} FROM {rows or table_name} WHERE NOT ({nulls})))"""


KEYS_SQL = " UNION ALL ".join([
    _key_sql("l_orderkey", "lineitem", "l_orderkey"),
    _key_sql("l_orderkey+l_linenumber", "lineitem", "l_orderkey, l_linenumber"),
    _key_sql("l_orderkey+l_partkey+l_suppkey+l_linenumber", "lineitem", "l_orderkey, l_partkey, l_suppkey, l_linenumber"),
    _key_sql("l_returnflag", "lineitem", "l_returnflag"),
    _key_sql("c_custkey", "customer", "c_custkey"),
    _key_sql("c_name", "customer", "c_name"),
    _key_sql("c_nationkey", "customer", "c_nationkey"),
    _key_sql("vip", "customer", "vip", "(SELECT CASE WHEN c_acctbal > 0 THEN c_custkey END AS vip FROM customer)"),
    _key_sql("conv_id", "conversations", "conv_id"),
    _key_sql("conv_id+turn", "conversations", "conv_id, turn"),
])
TABLE_LIST = ", ".join(f"'{t}'" for t in TABLES)
COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS row_count FROM {t}" for t in TABLES)

QUERIES = {
    "column_catalog": column_catalog,
    "table_row_counts": table_row_counts,
    "infer_json_types": infer_json_types,
    "infer_json_paths": infer_paths,
    "infer_source_catalog": infer_source_catalog,
    "catalog_summary": summary,
    "pipeline_summary": whole_summary,
    "match_entities": matches_of_sources,
    "active_sources": active_sources_query,
    "propose_fields": fields_proposed,
    "propose_mappings": mappings_proposed,
    "merge_key_candidates": merge_keys,
    "discover_merge_keys": discover_keys,
}
ORACLES = {
    "column_catalog": f"""
WITH counts AS ({COUNTS})
SELECT 'spark' AS source, 'parquet' AS platform, 'testdata' AS database, table_name AS "table", ordinal_position AS ordinal,
  column_name AS name, CASE data_type WHEN 'BIGINT' THEN 'integer' WHEN 'INTEGER' THEN 'integer' WHEN 'DOUBLE' THEN 'float'
    WHEN 'TIMESTAMP' THEN 'timestamp' ELSE 'string' END AS data_type, TRUE AS nullable, FALSE AS is_primary_key, row_count
FROM information_schema.columns JOIN counts ON counts."table" = table_name""",
    "table_row_counts": COUNTS,
    "infer_json_types": INFER_SQL,
    "infer_json_paths": PATHS_SQL,
    "infer_source_catalog": f"WITH {SOURCE_COLUMNS} SELECT * FROM catalog",
    "catalog_summary": f"""WITH {SOURCE_COLUMNS},
t AS (SELECT source, "table", count(*) AS n_columns, max(row_count) AS n_rows FROM catalog GROUP BY source, "table")
SELECT source, count(*) AS n_tables, CAST(sum(n_columns) AS BIGINT) AS n_columns, CAST(sum(n_rows) AS BIGINT) AS n_rows
FROM t GROUP BY source""",
    "pipeline_summary": WHOLE_SUMMARY_SQL,
    "match_entities": MATCH_SQL + """
SELECT canonical_name, min("table") FILTER (WHERE source = 'postgres') AS postgres_table,
  min("table") FILTER (WHERE source = 'sqlserver') AS sqlserver_entity,
  min("table") FILTER (WHERE source = 'teradata') AS teradata_table
FROM named GROUP BY canonical_name""",
    "active_sources": MATCH_SQL + 'SELECT canonical_name, source, "table", row_count FROM named',
    "propose_fields": FIELDS_SQL,
    "propose_mappings": MAPPINGS_SQL,
    "merge_key_candidates": KEYS_SQL,
    "discover_merge_keys": _all_keys_sql(),
}
