"""Change-event envelope: encode source rows, decode log rows, set aside what cannot be decoded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Event types of the envelope.
EVENT_TYPES = ("INSERT", "UPDATE", "DELETE", "SNAPSHOT")

# Fields of the envelope and of its metadata.
METADATA_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("database", T.StringType()),
    T.StructField("lsn", T.StringType()),
])
# Payload and before are kept as JSON text: their fields differ from source to source.
EVENT_SCHEMA = T.StructType([
    *[T.StructField(n, T.StringType()) for n in
      ("event_id", "event_type", "source", "entity", "timestamp", "payload", "before")],
    T.StructField("metadata", METADATA_SCHEMA),
])
LOG_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


# Names of the zone in which local times are those of UTC.
UTC_NAMES = ("UTC", "Etc/UTC", "Z", "GMT", "Etc/GMT", "UCT", "Etc/UCT", "Zulu", "+00:00")


def _session_is_utc() -> bool:
    session = SparkSession.getActiveSession()
    return session is not None and session.conf.get("spark.sql.session.timeZone") in UTC_NAMES


def iso_text(ts: Column) -> Column:
    """ISO-8601 in UTC with microseconds and offset, whatever the session's time zone is."""
    instant = ts.cast("timestamp")
    if _session_is_utc():
        return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    micros = F.pmod(F.unix_micros(instant), F.lit(1_000_000)).cast("string")
    plain = F.replace(F.substring(utc_clock(ts).cast("string"), 1, 19), F.lit(" "), F.lit("T"))
    return F.concat(plain, F.lit("."), F.lpad(micros, 6, "0"), F.lit("+00:00"))


def utc_clock(ts: Column) -> Column:
    """An instant as the local time that UTC clocks show.  In a session of another zone by counting from 1970, because
    its own local times name some instants twice."""
    if _session_is_utc():
        return ts.cast("timestamp").cast("timestamp_ntz")
    micros = F.unix_micros(ts.cast("timestamp"))
    seconds = F.expr("INTERVAL '1' SECOND") * F.floor(micros / 1_000_000).cast("long")
    rest = F.expr("INTERVAL '0.000001' SECOND") * F.pmod(micros, F.lit(1_000_000))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + seconds + rest


def in_utc(value: Column, dtype: T.DataType) -> Column:
    """Every instant in a value as UTC clock time, so that the value's text does not depend on the session."""
    if isinstance(dtype, T.TimestampType):
        return utc_clock(value)
    if isinstance(dtype, T.StructType):
        fields = [in_utc(value[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: in_utc(x, dtype.elementType))
    return value


def utc_now_text() -> Column:
    return iso_text(F.current_timestamp())


def json_ready(value: Column, dtype: T.DataType) -> Column:
    """Values JSON has no form for (decimal, date, time, binary) become their text; instants with their offset."""
    if isinstance(dtype, T.TimestampType):
        return iso_text(value)
    if isinstance(dtype, (T.DecimalType, T.DateType, T.TimestampNTZType, T.BinaryType)):
        return value.cast("string")
    if isinstance(dtype, T.StructType):
        fields = [json_ready(value[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: json_ready(x, dtype.elementType))
    return value


def payload_struct(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    chosen = columns or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.struct(*[json_ready(F.col(f"`{c}`"), types[c]).alias(c) for c in chosen])


def event_key(df: DataFrame, entity: str) -> Column:
    """Partition key: the first of ``<entity>_id``, ``id``, ``ID`` that is a column, as text."""
    for name in (f"{entity}_id", "id", "ID"):
        if name in df.columns:
            return F.col(name).cast("string")
    return F.lit(None).cast("string")


def topic_name(entity: Column | str, prefix: str = "canonical") -> Column:
    return F.concat_ws(".", F.lit(prefix), F.lit(entity) if isinstance(entity, str) else entity)


def event_id(*parts: Column) -> Column:
    """Replayable id: equal input gives an equal id, so a republished row can be recognised."""
    return F.sha2(F.to_json(F.array(*[p.cast("string") for p in parts])), 256)


def encode_events(
    df: DataFrame,
    source: str,
    entity: str,
    event_type: str | Column = "SNAPSHOT",
    table: str | None = None,
    database: str | None = None,
    lsn: Column | None = None,
    event_time: Column | None = None,
    key: Column | None = None,
    before: Column | None = None,
    payload_columns: Sequence[str] | None = None,
    version: Column | None = None,
) -> DataFrame:
    """Wrap every row in the envelope.

    The result has the envelope columns (payload and before still structured) and ``key``.  The id
    hashes source, entity, table, key, time and the payload's fields; without an ``event_time`` the
    time is now and is left out of the id, so a row that changes back and forth repeats its ids: give a ``version``
    (it enters the id) before repeated ids are dropped.  A row keeps its id whether it comes as SNAPSHOT or INSERT.
    """
    kind = F.lit(event_type) if isinstance(event_type, str) else event_type
    payload = payload_struct(df, payload_columns)
    key = event_key(df, entity) if key is None else key.cast("string")
    stamp = utc_now_text() if event_time is None else iso_text(event_time)
    chosen = payload_columns or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    id_parts = [
        F.lit(source), F.lit(entity), F.lit(table or entity), key,
        F.lit("") if event_time is None else stamp,
        F.when(kind.isin("SNAPSHOT", "INSERT"), "ROW").otherwise(kind),
        *([] if version is None else [version]),
        *[in_utc(F.col(f"`{c}`"), types[c]) for c in chosen],
    ]
    return df.select(
        event_id(*id_parts).alias("event_id"),
        kind.alias("event_type"),
        F.lit(source).alias("source"),
        F.lit(entity).alias("entity"),
        stamp.alias("timestamp"),
        payload.alias("payload"),
        (F.lit(None).cast("string") if before is None else before).alias("before"),
        F.struct(
            F.lit(table or entity).alias("table"),
            F.lit(database or "").alias("database"),
            (F.lit("") if lsn is None else F.coalesce(lsn.cast("string"), F.lit(""))).alias("lsn"),
        ).alias("metadata"),
        key.alias("key"),
    )


def serialise(events: DataFrame, prefix: str = "canonical", keep: Sequence[str] = ()) -> DataFrame:
    """Envelope columns -> log rows (key, value, topic, and the columns to keep); nulls are written out."""
    body = F.to_json(F.struct(*EVENT_SCHEMA.names), {"ignoreNullFields": "false"})
    return events.select(
        F.encode("key", "UTF-8").alias("key"),
        F.encode(body, "UTF-8").alias("value"),
        topic_name(F.col("entity"), prefix).alias("topic"),
        *keep,
    )


def decode_events(log: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Log rows -> the 11 decoded columns (their names are fixed values).  ``keep_raw`` adds ``raw_value`` for the dead-letter split."""
    raw = ["raw_value", "raw_topic"] if keep_raw else []
    parsed = log.select(
        F.col("offset").alias("kafka_offset"),
        F.col("partition").alias("kafka_partition"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.from_json(F.col("value").cast("string"), EVENT_SCHEMA).alias("event"),
        F.col("value").alias("raw_value"),
        F.col("topic").alias("raw_topic"),
    )
    # A generator of one row keeps later filters on event fields from parsing the value once more.
    opened = parsed.select(
        "kafka_offset", "kafka_partition", "kafka_timestamp", *raw, F.inline_outer(F.array("event")))
    return opened.select(
        "kafka_offset", "kafka_partition", "kafka_timestamp", "event_id", "event_type", "source", "entity",
        F.col("timestamp").alias("event_timestamp"),
        "payload",
        F.col("metadata.table").alias("source_table"),
        F.col("metadata.database").alias("source_database"),
        *raw,
    )


def is_dead_letter() -> Column:
    return F.col("event_id").isNull()


def valid_event_type() -> Column:
    return F.coalesce(F.col("event_type").isin(*EVENT_TYPES), F.lit(False))


def live_events(decoded: DataFrame) -> DataFrame:
    """Rows whose envelope could be read."""
    return decoded.filter(~is_dead_letter()).drop("raw_value", "raw_topic")


def dead_letters(decoded: DataFrame) -> DataFrame:
    """Rows whose envelope could not be read, with their bytes and the reason."""
    reason = F.when(F.col("raw_value").isNull(), "empty").otherwise("malformed")
    return decoded.filter(is_dead_letter()).select(
        F.col("raw_topic").alias("topic"), "kafka_partition", "kafka_offset", "kafka_timestamp",
        F.col("raw_value").alias("value"), reason.alias("reason"),
    )


def with_position(rows: DataFrame, partitions: int, offset: Column, timestamp: Column) -> DataFrame:
    """Give log rows a partition (by key hash) and a caller-defined offset."""
    return rows.select(
        "key", "value", "topic",
        F.pmod(F.hash("key"), F.lit(partitions)).cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
    )
