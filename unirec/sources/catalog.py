"""Column catalogues: one row per column, whatever the source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATALOG_COLUMNS = (
    "source", "platform", "database", "table", "ordinal", "name", "data_type", "nullable",
    "is_primary_key", "row_count",
)
# Canonical type name of a Spark type; any other is a string.
TYPE_NAMES = {
    "tinyint": "integer", "smallint": "integer", "int": "integer", "bigint": "integer",
    "float": "float", "double": "float", "boolean": "boolean", "date": "date",
    "timestamp": "timestamp", "timestamp_ntz": "timestamp",
}


def type_name(dtype: T.DataType) -> str:
    return TYPE_NAMES.get(dtype.simpleString(), "string")


def normalise_columns(rows: DataFrame) -> DataFrame:
    """Column metadata in one form: lower-case names, ``column_name`` as a fallback for ``name``,
    and defaults for what a source does not tell."""
    rows = rows.toDF(*[c.lower() for c in rows.columns])

    def given(name: str, default: object) -> Column:
        fallback = F.lit(default)
        return F.coalesce(F.col(name).try_cast(_kind(default)), fallback) if name in rows.columns else fallback

    names = [F.col(c) for c in ("name", "column_name") if c in rows.columns]
    name = F.coalesce(*names, F.lit(""))
    kept = [F.col(c) for c in ("table", "table_name", "ordinal") if c in rows.columns]
    return rows.select(
        *kept,
        name.alias("name"),
        given("data_type", "unknown").alias("data_type"),
        given("nullable", True).alias("nullable"),
        given("is_primary_key", False).alias("is_primary_key"),
    )


def _kind(default: object) -> str:
    return "boolean" if isinstance(default, bool) else "string"


def _catalog(rows: DataFrame, source: str, platform: str, database: str) -> DataFrame:
    return normalise_columns(rows).select(
        F.lit(source).alias("source"), F.lit(platform).alias("platform"), F.lit(database).alias("database"),
        "table", "ordinal", "name", "data_type", "nullable", "is_primary_key",
        F.lit(None).cast("bigint").alias("row_count"),
    )


def information_schema_catalog(tables: DataFrame, columns: DataFrame, schema: str, database: str) -> DataFrame:
    """Catalogue from ``information_schema`` views: base tables of one schema and their columns."""
    base = tables.filter(
        (F.col("table_schema") == schema) & (F.col("table_type") == "BASE TABLE")
        & (F.coalesce("table_name", F.lit("")) != "")
    ).select("table_name")
    rows = columns.filter(F.col("table_schema") == schema).join(base, "table_name", "left_semi").select(
        F.col("table_name").alias("table"),
        F.col("ordinal_position").alias("ordinal"),
        F.col("column_name").alias("name"),
        "data_type",
        (F.col("is_nullable") == "YES").alias("nullable"),
    )
    return _catalog(rows, "postgres", "postgres", database).orderBy("table", "ordinal")


def dictionary_catalog(tables: DataFrame, columns: DataFrame, database: str) -> DataFrame:
    """Catalogue from data-dictionary views with padded names: tables of kind ``T`` and their columns."""
    base = tables.filter(
        (F.trim("DatabaseName") == database) & (F.col("TableKind") == "T")
        & (F.coalesce(F.trim("TableName"), F.lit("")) != "")
    ).select(F.trim("TableName").alias("table"))
    rows = columns.filter(F.trim("DatabaseName") == database).select(
        F.trim("TableName").alias("table"),
        F.col("ColumnId").alias("ordinal"),
        F.trim("ColumnName").alias("name"),
        F.trim("ColumnType").alias("data_type"),
        F.when(F.col("Nullable") == "Y", True).otherwise(False).alias("nullable"),
    ).join(base, "table", "left_semi")
    return _catalog(rows, "teradata", "teradata", database).orderBy("table", "ordinal")


def column_statistics(tables: dict[str, DataFrame]) -> DataFrame:
    """``table, name, row_count, value_count`` of every column: its rows and its values that are not null."""
    parts = []
    for table, df in tables.items():
        counts = df.agg(F.count("*").alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)])
        each = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"_{i}").alias("value_count")) for i, c in enumerate(df.columns)])
        parts.append(counts.select(F.lit(table).alias("table"), F.explode(each).alias("c"), F.col("_rows").alias("row_count"))
                     .select("table", "c.name", "row_count", "c.value_count"))
    return reduce(DataFrame.unionByName, parts)


def with_statistics(catalog: DataFrame, statistics: DataFrame) -> DataFrame:
    """The catalogue with ``row_count`` and ``value_count`` from measured statistics; columns without them have nulls."""
    measured = statistics.select("table", "name", "row_count", "value_count")
    return catalog.drop("row_count").join(measured, ["table", "name"], "left").select(*CATALOG_COLUMNS, "value_count")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``table, row_count`` of every table."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table"), "row_count")
              for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def table_catalog(
    spark: SparkSession, tables: dict[str, DataFrame], source: str, platform: str, database: str,
) -> DataFrame:
    """Catalogue of Spark tables from their schemas, with their row counts."""
    described = [
        (name, i + 1, f.name, type_name(f.dataType), f.nullable)
        for name, df in tables.items() for i, f in enumerate(df.schema.fields)
    ]
    rows = spark.createDataFrame(
        described, "table string, ordinal int, name string, data_type string, nullable boolean")
    catalog = _catalog(rows, source, platform, database).drop("row_count")
    return catalog.join(row_counts(tables), "table").select(*CATALOG_COLUMNS)


def session_tables(spark: SparkSession, database: str | None = None) -> dict[str, DataFrame]:
    """Base tables of the session catalogue, by name."""
    listed = spark.catalog.listTables(database)
    names = sorted(t.name for t in listed if not t.isTemporary and t.tableType != "VIEW")
    return {n: spark.table(f"{database}.{n}" if database else n) for n in names}
