"""Filling the log: first the whole source, at once or by key ranges, then what lies above its watermark."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from unirec.functions.shared import read_state, stored, write_state
from unirec.operators.diff import snapshot_diff
from unirec.operators.ranges import in_range, key_bounds
from unirec.sources.envelope import encode_events, json_ready
from unirec.sources.scan import highest_timestamp, incremental_scan
from unirec.sources.topics import file_log, next_offset, publish_to_file_log
from unirec.sources.watermarks import advance_watermark, current_watermark


def publish_increment(
    df: DataFrame, source: str, entity: str, ts_column: str, log_path: str, watermark_path: str,
    event_type: str | None = None, **envelope: object,
) -> int:
    """One poll of a source table: publish its rows above the watermark, then advance the watermark to
    the highest time among them.  Returns the number published.

    The first poll publishes the whole table as SNAPSHOT, later ones as INSERT.  Stopping in between
    publishes the same rows again; their ids are the same, so readers can drop them.
    """
    spark = df.sparkSession
    mark = current_watermark(spark, watermark_path, source, entity)
    kind = event_type or ("SNAPSHOT" if mark is None else "INSERT")
    read = Observation()
    fresh = incremental_scan(df, ts_column, mark).observe(
        read, F.count(F.lit(1)).alias("n"), highest_timestamp(ts_column).alias("mark"))
    events = encode_events(fresh, source, entity, kind, event_time=F.col(ts_column), **envelope)
    publish_to_file_log(events, log_path)
    if read.get["n"]:
        advance_watermark(spark, watermark_path, source, entity, read.get["mark"])
    return read.get["n"]


def backfill_chunks(
    read: Callable[[], DataFrame], source: str, entity: str, key: str, log_path: str, state_path: str, chunks: int = 16,
    between: Callable[[int], None] | None = None, most: int | None = None, **envelope: object,
) -> int:
    """Publish a source table as SNAPSHOT events by ranges of its key, while its changes are published too.

    A chunk is read between two marks of the log.  Keys whose changes came into the log between the marks are left out of the
    chunk, whose rows may be older; so the last event of a key in the log is its newest, whatever a row's own time says.
    ``between`` is called after a chunk was read and before its second mark: there the one loop that publishes polls for
    changes.  After every chunk its number is stored, and a run that broke off goes on at its chunk; ``most`` ends a run
    after so many.  Returns the number of chunks that are left.
    """
    table = read()
    spark, dtype = table.sparkSession, table.schema[key].dataType
    text = read_state(spark, state_path)
    state = json.loads(text) if text else {"bounds": key_bounds(table, key, chunks), "next": 0}
    if not text:
        write_state(spark, state_path, json.dumps(state))
    count = len(state["bounds"]) + 1
    last = count if most is None else min(count, state["next"] + most)
    for number in range(state["next"], last):
        low = next_offset(spark, log_path)
        rows = read().filter(in_range(F.col(key), dtype, state["bounds"], number))
        chunk = stored(encode_events(rows, source, entity, "SNAPSHOT", key=F.col(key), **envelope), "chunk")
        if between:
            between(number)
        if next_offset(spark, log_path) > low:
            body = F.col("value").cast("string")
            changed = file_log(spark, log_path, [entity]).filter(
                (F.col("offset") >= low) & (F.get_json_object(body, "$.source") == source) & (F.get_json_object(body, "$.event_type") != "SNAPSHOT"))
            keys = changed.select(F.col("key").cast("string").alias("key")).distinct()
            chunk = chunk.join(keys, "key", "left_anti").select(*chunk.columns)
        publish_to_file_log(chunk, log_path)
        state["next"] = number + 1
        write_state(spark, state_path, json.dumps(state))
    return count - state["next"]


def diff_events(
    old: DataFrame, new: DataFrame, keys: Sequence[str], source: str, entity: str, version: str,
    event_time: Column | None = None, **envelope: object,
) -> DataFrame:
    """INSERT / UPDATE / DELETE events of two snapshots, for a source that has no change timestamp.

    ``version`` names the new snapshot.  It enters the ids, so that a change which comes again later is a new event.
    """
    changes = snapshot_diff(old, new, keys)
    columns = [c for c in changes.columns if c not in ("event_type", "before")]
    before = json_ready(F.col("before"), changes.schema["before"].dataType)
    return encode_events(
        changes, source, entity, F.col("event_type"), before=before, event_time=event_time, version=F.lit(version),
        payload_columns=columns, **envelope)
