"""Entity topics: a Kafka topic, or the same rows as a file log, read in batch or as a stream."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from unirec.functions.shared import child_names, read_state, write_state
from unirec.sources.envelope import LOG_SCHEMA, serialise

DEFAULT_PREFIX = "canonical"
DEFAULT_PARTITIONS = 3
NEXT_OFFSET = "_next_offset"


def topics_of(entities: Sequence[str], prefix: str = DEFAULT_PREFIX) -> list[str]:
    return [f"{prefix}.{e}" for e in entities]


def kafka_options(
    bootstrap_servers: str, entities: Sequence[str], prefix: str = DEFAULT_PREFIX,
    starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None, **extra: str,
) -> dict[str, str]:
    """Options of the Kafka source.  ``min_partitions`` splits a long topic partition over tasks."""
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": ",".join(topics_of(entities, prefix)),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
        **extra,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_stream(spark: SparkSession, bootstrap_servers: str, entities: Sequence[str], **kwargs: object) -> DataFrame:
    """Log rows of one or many entity topics; needs the Kafka connector on the class path."""
    options = kafka_options(bootstrap_servers, entities, **kwargs)
    return spark.readStream.format("kafka").options(**options).load().select(*LOG_SCHEMA.names)


def publish_to_kafka(events: DataFrame, bootstrap_servers: str, prefix: str = DEFAULT_PREFIX, **options: str) -> None:
    (serialise(events, prefix).write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap_servers).option("kafka.acks", "all").options(**options).save())


def _log_glob(path: str, entities: Sequence[str] | None, prefix: str) -> str:
    if entities is None:
        return f"{path}/topic=*"
    # Always a glob: a stream takes a plain folder as its own base path and loses the topic column.
    return f"{path}/topic={{{','.join(topics_of(entities, prefix))}}}"


def file_log(spark: SparkSession, path: str, entities: Sequence[str] | None = None, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    reader = spark.read.schema(LOG_SCHEMA).option("basePath", path)
    return reader.parquet(_log_glob(path, entities, prefix)).select(*LOG_SCHEMA.names)


def file_log_stream(
    spark: SparkSession, path: str, entities: Sequence[str] | None = None, prefix: str = DEFAULT_PREFIX,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Log rows of a file log as a stream; the rate limit counts files instead of offsets."""
    reader = spark.readStream.schema(LOG_SCHEMA).option("basePath", path)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(_log_glob(path, entities, prefix)).select(*LOG_SCHEMA.names)


def publish_to_file_log(
    events: DataFrame, path: str, prefix: str = DEFAULT_PREFIX, partitions: int = DEFAULT_PARTITIONS,
) -> None:
    """Append events to a file log; one publisher at a time.

    Offsets grow with every call and are unique, but not dense: they need no global sort, so publishing stays a
    map-only job.  The next offset is a small record beside the topics, so a call does not look at what earlier ones
    wrote; only after a call that broke off is the log scanned for its highest offset.  Rows without a key are spread
    over the partitions.
    """
    spark = events.sparkSession
    base = next_offset(spark, path)
    write_state(spark, f"{path}/{NEXT_OFFSET}", json.dumps({"next": base, "open": True}))
    number = F.monotonically_increasing_id()
    rows = serialise(events, prefix).withColumn("offset", number + F.lit(base).cast("long"))
    slot = F.when(F.col("key").isNotNull(), F.hash("key").cast("long")).otherwise(F.col("offset"))
    written = Observation()
    rows.select(
        "key", "value", "topic",
        F.pmod(slot, F.lit(partitions)).cast("int").alias("partition"),
        "offset",
        F.current_timestamp().alias("timestamp"),
    ).observe(written, F.max("offset").alias("last")).write.mode("append").partitionBy("topic").parquet(path)
    last = written.get["last"]
    write_state(spark, f"{path}/{NEXT_OFFSET}", json.dumps({"next": base if last is None else last + 1, "open": False}))


def next_offset(spark: SparkSession, path: str) -> int:
    """The offset that the next event will have at least: a mark of the log."""
    text = read_state(spark, f"{path}/{NEXT_OFFSET}")
    known = json.loads(text) if text else None
    if known and not known["open"]:
        return known["next"]
    floor = known["next"] if known else 0
    if not any(name.startswith("topic=") for name in child_names(spark, path)):
        return floor
    highest = spark.read.schema(LOG_SCHEMA).parquet(f"{path}/topic=*").agg(F.max("offset")).first()[0]
    return floor if highest is None else max(floor, highest + 1)
