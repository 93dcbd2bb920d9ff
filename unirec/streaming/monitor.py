"""State of the running queries."""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

PROGRESS_COLUMNS = (
    "query string, run_id string, batch_id bigint, timestamp string, input_rows bigint, "
    "rows_per_second double, duration_ms bigint"
)
STATUS_COLUMNS = "query string, id string, active boolean, message string, error string"


def progress_table(spark: SparkSession, queries: Iterable[StreamingQuery] | None = None) -> DataFrame:
    """Recent progress of queries, one row per batch; Spark keeps a bounded number of them."""
    rows = [
        (p.name, str(p.runId), p.batchId, p.timestamp, p.numInputRows, p.processedRowsPerSecond, p.batchDuration)
        for q in (spark.streams.active if queries is None else queries) for p in q.recentProgress
    ]
    return spark.createDataFrame(rows, PROGRESS_COLUMNS)


def status_table(spark: SparkSession, queries: Iterable[StreamingQuery] | None = None) -> DataFrame:
    rows = []
    for q in spark.streams.active if queries is None else queries:
        error = q.exception()
        rows.append((q.name, q.id, q.isActive, q.status["message"], str(error) if error else None))
    return spark.createDataFrame(rows, STATUS_COLUMNS)


def stop_gracefully(queries: Iterable[StreamingQuery], seconds: float = 60.0) -> list[str]:
    """Stop queries between two batches, so that no batch is cut short.  A query that does not come to its end in time is
    stopped all the same (its batch is repeated from the checkpoint) and named in the result; the first failure is raised."""
    late = []
    for q in queries:
        end = time.monotonic() + seconds
        while q.isActive and q.status["isTriggerActive"] and time.monotonic() < end:
            time.sleep(0.05)
        if q.isActive and q.status["isTriggerActive"]:
            late.append(q.name)
        q.stop()
        failed = q.exception()
        if failed:
            raise failed
    return late


def stop_all(spark: SparkSession) -> None:
    for q in spark.streams.active:
        q.stop()
