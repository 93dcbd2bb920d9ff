"""Warehouse sink: canonical rows appended per batch, with batch metadata, written by the executors."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unirec.sinks.commits import Commits
from unirec.sinks.days import DayTable
from unirec.sources.envelope import utc_now_text


def table_name(entity: str) -> str:
    return f"STREAM_CANONICAL_{entity.upper()}"


def create_namespace(spark: SparkSession, name: str) -> None:
    quoted = ".".join(f"`{part}`" for part in name.split("."))
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quoted}")


def datetime_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Text columns that read as timestamps as a whole: at least one value, and none that does not.

    One aggregation over the data returns two numbers per column.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    text = [c for c in text if columns is None or c in columns]
    if not text:
        return []
    checks = [
        check for i, c in enumerate(text) for check in (
            F.count(c).alias(f"n{i}"), F.count(F.col(c).try_cast("timestamp")).alias(f"t{i}"))
    ]
    found = df.agg(*checks).first()
    return [c for i, c in enumerate(text) if found[f"n{i}"] > 0 and found[f"n{i}"] == found[f"t{i}"]]


def coerce_datetimes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Named text columns as timestamps.  A stream should name them once: deciding per batch would let
    a column change its type between batches."""
    return df.withColumns({c: F.col(c).try_cast("timestamp") for c in columns}) if columns else df


def with_batch_metadata(batch: DataFrame, batch_id: int, batch_timestamp: str | None = None) -> DataFrame:
    stamp = utc_now_text() if batch_timestamp is None else F.lit(batch_timestamp)
    return batch.withColumn("_batch_id", F.lit(batch_id).cast("bigint")).withColumn("_batch_timestamp", stamp)


def warehouse_table(spark: SparkSession, path: str, schema: T.StructType, commits: Commits | None = None) -> DayTable:
    """Canonical rows of all batches with the time of their batch, in folders by ``_ingest_date``."""
    stamp = T.StructField("_batch_timestamp", T.StringType())
    return DayTable(spark, path, T.StructType([*schema.fields, stamp]), (), commits, "warehouse")


def warehouse_rows(batch: DataFrame, batch_id: int, batch_timestamp: str | None = None, datetimes: Sequence[str] = ()) -> DataFrame:
    return with_batch_metadata(coerce_datetimes(batch, datetimes), batch_id, batch_timestamp).drop("_batch_id")


def append_batch(
    batch: DataFrame, path: str, batch_id: int, run: int = 0, batch_timestamp: str | None = None,
    datetimes: Sequence[str] = (),
) -> None:
    """Append one batch as files; a replayed batch replaces its rows."""
    rows = warehouse_rows(batch, batch_id, batch_timestamp, datetimes)
    warehouse_table(batch.sparkSession, path, coerce_datetimes(batch, datetimes).schema).write_batch(rows, batch_id, run)


def read_warehouse(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[date] | None = None) -> DataFrame:
    """All rows of ``schema`` and their batch, or those of the named days."""
    return warehouse_table(spark, path, schema).read(days)


def create_or_append(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Append to a catalogue table, which the first batch creates, with its namespace; neither is ever replaced."""
    if "." in table:
        create_namespace(df.sparkSession, table.rsplit(".", 1)[0])
    df.write.mode("append").partitionBy(*partition_by).saveAsTable(table)
