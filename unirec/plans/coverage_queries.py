"""Queries of operators that only unit tests reached before: catalogues of other systems, polls on a source's own
column, backfill joined to a stream, tables made by their first batch, repeated keys and wide integers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unirec.functions.shared import new_folder, stored
from unirec.operators.profile import merge_key_candidates
from unirec.plans.derived import CUSTOMER, INGEST_DATE, source_rows, table
from unirec.plans.discovery_queries import TABLES, given_tables
from unirec.plans.mapping_queries import json_object, map_rows, rule_spec
from unirec.plans.sql import CUSTOMER_ROWS, canonical, customer_time, latest
from unirec.plans.stream_queries import ALL_NOW, BATCH_STAMP, POSITION
from unirec.sinks.warehouse import create_or_append
from unirec.sources.catalog import column_statistics, dictionary_catalog, information_schema_catalog, with_statistics
from unirec.sources.envelope import decode_events
from unirec.sources.topics import file_log, file_log_stream
from unirec.streaming.backfill import publish_increment
from unirec.streaming.entity import EntityStream

SHOWN = ["source", "database", "table", "ordinal", "name", "nullable", "is_primary_key", "row_count", "value_count"]
MIDDLE = datetime(2024, 1, 15)


def described(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """table, ordinal, name, data_type of the given tables, and the statistics of their columns."""
    tables = given_tables(spark, sf_dir)
    rows = [(name, i + 1, f.name, f.dataType.simpleString()) for name, df in tables.items() for i, f in enumerate(df.schema.fields)]
    columns = spark.createDataFrame(rows, "table string, ordinal int, name string, data_type string")
    return columns, stored(column_statistics(tables), "column-statistics")


def information_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given tables as ``information_schema`` views, beside a view, another schema and a table without a name."""
    columns, statistics = described(spark, sf_dir)
    # As such a system keeps them, a column without null is declared NOT NULL.
    columns = columns.join(statistics, ["table", "name"])
    names = columns.select("table").distinct()

    def listed(name, kind: str, schema: str) -> DataFrame:
        return names.select(F.lit(schema).alias("table_schema"), name.alias("table_name"), F.lit(kind).alias("table_type"))

    tables = listed(F.col("table"), "BASE TABLE", "public").unionByName(
        listed(F.concat("table", F.lit("_view")), "VIEW", "public")).unionByName(
        listed(F.col("table"), "BASE TABLE", "other")).unionByName(listed(F.lit(""), "BASE TABLE", "public").limit(1))
    shown = columns.select(
        F.explode(F.array(F.lit("public"), F.lit("other"))).alias("table_schema"), F.col("table").alias("table_name"),
        F.col("ordinal").alias("ordinal_position"), F.col("name").alias("column_name"), "data_type",
        F.when(F.col("value_count") < F.col("row_count"), "YES").otherwise("NO").alias("is_nullable"))
    shown = shown.unionByName(shown.filter("table_schema = 'public'").withColumn("table_name", F.concat("table_name", F.lit("_view"))))
    return with_statistics(information_schema_catalog(tables, shown, "public", "db"), statistics).select(*SHOWN)


def data_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given tables as a data dictionary with padded names, a view and another database."""
    columns, statistics = described(spark, sf_dir)
    columns = columns.join(statistics, ["table", "name"])
    pad = lambda c: F.rpad(c, 30, " ")
    names = columns.select("table").distinct()
    tables = names.select(pad(F.lit("dw")).alias("DatabaseName"), pad(F.col("table")).alias("TableName"), F.lit("T").alias("TableKind"))
    tables = tables.unionByName(tables.withColumns({"TableName": pad(F.concat(F.lit("v_"), F.trim("TableName"))), "TableKind": F.lit("V")}))
    shown = columns.select(
        F.explode(F.array(F.lit("dw"), F.lit("old"))).alias("DatabaseName"), pad(F.col("table")).alias("TableName"),
        F.col("ordinal").alias("ColumnId"), pad(F.col("name")).alias("ColumnName"), pad(F.col("data_type")).alias("ColumnType"),
        F.when(F.col("value_count") < F.col("row_count"), "Y").otherwise("N").alias("Nullable"))
    shown = shown.withColumn("DatabaseName", pad(F.col("DatabaseName")))
    return with_statistics(dictionary_catalog(tables, shown, "dw"), statistics).select(*SHOWN)


def catalog_sql(source: str, database: str) -> str:
    """Columns of the given tables alone, with counts of their rows and values."""
    counts = " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", name, value_count, (SELECT count(*) FROM {t}) AS row_count
  FROM (UNPIVOT (SELECT count(COLUMNS('(.*)')) AS '\\1' FROM {t}) ON COLUMNS(*) INTO NAME name VALUE value_count)""" for t in TABLES)
    return f"""
WITH counts AS ({counts}),
places AS (SELECT table_name AS "table", column_name AS name, min(ordinal_position) AS ordinal FROM information_schema.columns GROUP BY ALL)
SELECT '{source}' AS source, '{database}' AS database, "table", CAST(ordinal AS INTEGER) AS ordinal, name,
  value_count < row_count AS nullable, false AS is_primary_key, row_count, value_count
FROM counts JOIN places USING ("table", name)"""


def poll_created_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three polls on the source's own column ``created_ts``; the last finds nothing new."""
    folder = new_folder(spark, "poll-created")
    rows = source_rows(spark, sf_dir, "customer", "teradata")
    for seen in (rows.filter(F.col("created_ts") <= F.lit(MIDDLE)), rows, rows):
        publish_increment(seen, "teradata", "customer", "created_ts", f"{folder}/log", f"{folder}/marks", key=F.col("cust_id"))
    counted = decode_events(file_log(spark, f"{folder}/log", ["customer"])).groupBy("event_type").agg(
        F.count("*").alias("n_events"), F.countDistinct("event_id").alias("n_ids"))
    return counted


def backfill_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot of the early rows, a stream run, polls of the rest with one poll repeated, a stream run from the same
    checkpoint, and a run without any new file: one canonical table."""
    folder = new_folder(spark, "backfill")
    log, marks = f"{folder}/log", f"{folder}/marks"
    stream = EntityStream(spark, CUSTOMER, folder, mode="event_time", ingest_date=INGEST_DATE, batch_timestamp=BATCH_STAMP,
                          dedup_delay="3650 days")
    rows = {s: source_rows(spark, sf_dir, "customer", s) for s in ("postgres", "sqlserver")}
    keys = {"postgres": "id", "sqlserver": "Id"}
    for limit in (MIDDLE, None, None):
        for source, df in rows.items():
            seen = df if limit is None else df.filter(F.col("updated_at") <= F.lit(limit))
            publish_increment(seen, source, "customer", "updated_at", log, marks, key=F.col(keys[source]))
        stream.start(file_log_stream(spark, log, ["customer"]), ["canonical"], ALL_NOW).awaitTermination()
    return stream.read_canonical().drop(*POSITION, "_event_type")


def create_or_append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first batch makes the table and its namespace, an empty one changes nothing, the last adds to it."""
    name = "staged.canonical_" + new_folder(spark, "t").rsplit("-", 1)[1]
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    finished = F.col("o_orderstatus") == "F"
    for batch in (rows.filter(finished), rows.filter("o_orderkey < -1"), rows.filter(~finished)):
        create_or_append(batch, name, ["o_orderstatus"])
    return spark.table(name).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("last_key"))


def key_from_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidate that identifies every row, with the fewest columns."""
    profile = merge_key_candidates(table(spark, sf_dir, "orders"), [["o_orderstatus"], ["o_custkey"], ["o_orderkey"], ["o_orderkey", "o_custkey"]])
    return profile.filter("is_key").orderBy(F.size(F.split("candidate", r"\+")), "candidate").limit(1).select("candidate", "n_rows")


def map_repeated_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that a payload repeats counts at its first place with its last value; another spelling of it stays apart."""
    spec = rule_spec([("id", "integer"), ("n", "integer")], [("id", "id", None), ("v", "n", "CAST AS INT")])
    key, other = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    plain = json_object(("id", key), ("v", F.lit('"z"')), ("v", other))
    spelled = json_object(("id", key), ("v", F.lit("1")), ("V", other), ("v", F.lit("3")))
    return map_rows(table(spark, sf_dir, "orders"), F.when(F.col("o_orderstatus") == "F", plain).otherwise(spelled), spec)


def map_int_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers up to the largest long are kept; what is larger becomes null and empties nothing else."""
    spec = rule_spec([("id", "integer"), ("n", "integer")], [("id", "id", None), ("v", "n", "CAST AS INT")])
    big = F.when(F.col("o_orderstatus") == "F", "9223372036854775807").when(F.col("o_orderstatus") == "O", "9223372036854775808").otherwise("1e19")
    return map_rows(table(spark, sf_dir, "orders"), json_object(("id", F.col("o_orderkey").cast("string")), ("v", big)), spec)


QUERIES = {
    "information_schema_catalog": information_schema,
    "dictionary_catalog": data_dictionary,
    "poll_created_ts": poll_created_ts,
    "backfill_then_stream": backfill_then_stream,
    "create_or_append_table": create_or_append_table,
    "key_from_profile": key_from_profile,
    "map_repeated_key": map_repeated_key,
    "map_int_overflow": map_int_overflow,
}
ORACLES = {
    "information_schema_catalog": catalog_sql("postgres", "db"),
    "dictionary_catalog": catalog_sql("teradata", "dw"),
    "poll_created_ts": f"""
WITH c AS (SELECT {customer_time(2)} AS t FROM customer)
SELECT CASE WHEN t <= TIMESTAMP '2024-01-15' THEN 'SNAPSHOT' ELSE 'INSERT' END AS event_type, count(*) AS n_events, count(*) AS n_ids
FROM c GROUP BY 1""",
    "backfill_then_stream": f"""WITH {CUSTOMER_ROWS}, c AS (SELECT * FROM ({canonical('customer_rows')}) WHERE _source <> 'teradata')
SELECT * EXCLUDE (_event_type) FROM ({latest('c', 'customer_id', 'updated_at DESC')})""",
    "create_or_append_table": "SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS last_key FROM orders GROUP BY o_orderstatus",
    "key_from_profile": "SELECT 'o_orderkey' AS candidate, count(*) AS n_rows FROM orders",
    "map_repeated_key": "SELECT o_orderkey AS id, o_custkey AS n FROM orders",
    "map_int_overflow": """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 9223372036854775807 END AS n FROM orders""",
}
