"""High-water marks: one record per source and entity, replaced when a higher mark is written."""

from __future__ import annotations

from datetime import UTC, datetime
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from unirec.functions.shared import child_names, read_state, write_state

WATERMARK_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("entity", T.StringType()),
    T.StructField("watermark", T.TimestampType()),
])


def _place(path: str, source: str, entity: str) -> str:
    """Names are quoted, so that any of them is one folder (a dot in front would hide it)."""
    return f"{path}/s-{quote(source, safe='')}/e-{quote(entity, safe='')}"


def watermarks(spark: SparkSession, path: str) -> DataFrame:
    """Current mark per source and entity; the work grows with their number and not with the polls."""
    rows = []
    for source in child_names(spark, path):
        for entity in child_names(spark, f"{path}/{source}"):
            names = unquote(source[2:]), unquote(entity[2:])
            rows.append((*names, current_watermark(spark, path, *names)))
    return spark.createDataFrame([r for r in rows if r[2] is not None], WATERMARK_SCHEMA)


def current_watermark(spark: SparkSession, path: str, source: str, entity: str) -> datetime | None:
    """Local time without a zone, as Spark hands timestamps to Python."""
    text = read_state(spark, _place(path, source, entity))
    return datetime.fromisoformat(text).astimezone().replace(tzinfo=None) if text else None


def advance_watermark(spark: SparkSession, path: str, source: str, entity: str, watermark: datetime) -> bool:
    """Replace the mark if the new one is higher; a poll that is repeated or comes late changes nothing."""
    now = current_watermark(spark, path, source, entity)
    new = watermark.astimezone()
    if now is not None and new <= now.astimezone():
        return False
    write_state(spark, _place(path, source, entity), new.astimezone(UTC).isoformat())
    return True
