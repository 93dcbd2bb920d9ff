"""Raw sink: every decoded event, appended per batch."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unirec.sinks.commits import Commits
from unirec.sinks.days import DAY, DayTable

WITHIN = ("source",)


def batch_folder(path: str, run: int, batch_id: int) -> str:
    return f"{path}/_run={run}/_batch_id={batch_id}"


def today(spark: SparkSession) -> date:
    """The session's date, so that a batch does not change its day while it is written."""
    return spark.range(1).select(F.current_date()).first()[0]


def raw_table(spark: SparkSession, path: str, schema: T.StructType, commits: Commits | None = None) -> DayTable:
    """The raw table: folders by ``_ingest_date`` and ``source``."""
    return DayTable(spark, path, schema, WITHIN, commits, "raw")


def dated(batch: DataFrame, ingest_date: date | Column) -> DataFrame:
    return batch.withColumn(DAY, F.lit(ingest_date) if isinstance(ingest_date, date) else ingest_date)


def write_raw_batch(
    batch: DataFrame, path: str, batch_id: int, run: int = 0, ingest_date: date | Column | None = None,
) -> None:
    """Write one batch below the folders of its day.

    A replayed batch replaces its rows, also on a later day, so nothing is written twice.  ``run`` must be raised when a
    stream starts from a fresh checkpoint, whose batch numbers begin again.
    """
    if ingest_date is None:
        ingest_date = today(batch.sparkSession)
    rows = dated(batch, ingest_date)
    days = [ingest_date] if isinstance(ingest_date, date) else None
    raw_table(batch.sparkSession, path, batch.schema).write_batch(rows, batch_id, run, days)


def read_raw(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[date] | None = None) -> DataFrame:
    """The raw table, or the named days of it: then no other day is listed."""
    return raw_table(spark, path, schema).read(days)
