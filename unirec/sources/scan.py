"""Batch scans: snapshots, increments above a watermark, wrapped JSON documents."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Keys under which a document may hold its records, in order of precedence.
CONTAINER_KEYS = ("rows", "result", "data", "records", "value")


def jdbc_options(
    url: str, table: str, partition_column: str | None = None, lower: object = None, upper: object = None,
    partitions: int | None = None, fetch_size: int = 10_000, **properties: str,
) -> dict[str, str]:
    """Reader options of a table scan; with bounds the scan is split over ``partitions`` tasks."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **properties}
    if partition_column is not None:
        if lower is None or upper is None or partitions is None:
            raise ValueError("a partitioned scan needs lower, upper and partitions")
        options |= {
            "partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def jdbc_scan(spark: SparkSession, url: str, table: str, **kwargs: object) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()


def lower_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def incremental_scan(df: DataFrame, ts_column: str, watermark: datetime | Column | None) -> DataFrame:
    """Rows strictly above the watermark; all rows when there is none.  The filter reaches the source."""
    if watermark is None:
        return df
    bound = watermark if isinstance(watermark, Column) else F.lit(watermark).cast(df.schema[ts_column].dataType)
    return df.filter(F.col(ts_column) > bound)


def highest_timestamp(ts_column: str) -> Column:
    """Next watermark: the highest time among the rows read, so that nothing committed later is lost."""
    return F.max(F.col(ts_column).cast("timestamp"))


def unwrap_records(docs: DataFrame, column: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per record of JSON documents, as ``record`` (its JSON text).

    A document is a list of records, an object that holds the list under one of the container keys,
    or a list of blocks whose ``text`` is a record's JSON.  A document that is none of these, or not
    JSON, gives no rows.
    """
    doc = F.col(column)
    keys = F.json_object_keys(doc)
    held = F.lit(None).cast("string")
    for name in reversed(CONTAINER_KEYS):
        held = F.when(F.array_contains(keys, name), F.get_json_object(doc, f"$.{name}")).otherwise(held)
    items = F.from_json(F.when(keys.isNotNull(), held).otherwise(doc), "array<string>")
    listed = docs.select(
        *keep,
        (keys.isNull() & F.coalesce(F.array_contains(F.json_object_keys(F.get(items, F.lit(0))), "text"), F.lit(False))).alias("_blocks"),
        F.explode_outer(items).alias("_item"),  # empty documents fall to the filter below
    )
    text = F.get_json_object("_item", "$.text")
    record = F.when(~F.col("_blocks"), F.col("_item")).when(F.try_parse_json(text).isNotNull(), text)
    return listed.select(*keep, record.alias("record")).filter(F.col("record").isNotNull())


def read_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Whole JSON documents, one row per file, as column ``document``."""
    return spark.read.text(paths, wholetext=True).withColumnRenamed("value", "document")
