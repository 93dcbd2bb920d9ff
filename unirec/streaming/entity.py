"""Streaming queries of one entity: raw, canonical and warehouse sink, apart or as one fan-out."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from datetime import date
from functools import cached_property, reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from unirec.functions.shared import child_names, path_exists, remove, write_text
from unirec.operators.latest import PLACE
from unirec.operators.mapping import STRICT, apply_canonical_mapping, expand_canonical_fields
from unirec.operators.upsert import ARRIVAL
from unirec.sinks import raw, warehouse
from unirec.sinks.commits import Commits
from unirec.sinks.days import DayTable
from unirec.sinks.golden import BATCH, RUN, GoldenTable
from unirec.sources.envelope import LOG_SCHEMA, dead_letters, decode_events, is_dead_letter, live_events
from unirec.spec import EntitySpec

# Trigger intervals of the lake sinks and of the warehouse sink.
LAKE_TRIGGER = "30 seconds"
WAREHOUSE_TRIGGER = "60 seconds"

SINKS = ("raw", "canonical", "warehouse")


@dataclass
class EntityStream:
    """Where and how one entity's stream is written.

    ``run`` must be raised when the checkpoints below ``root`` are thrown away and the stream starts
    again, because batch numbers then begin at zero.
    """

    spark: SparkSession
    spec: EntitySpec
    root: str
    mode: str = ARRIVAL
    mapping_mode: str = STRICT
    delete_policy: str = "keep"
    run: int = 0
    ingest_date: date | None = None
    batch_timestamp: str | None = None
    datetimes: Sequence[str] = ()
    buckets: int | None = None
    sources: tuple[str, ...] | None = None
    dedup_delay: str | None = None

    # --- layout ---

    def folder(self, sink: str) -> str:
        name = warehouse.table_name(self.spec.name) if sink == "warehouse" else self.spec.name
        return f"{self.root}/{sink}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}/{self.spec.name}"

    # --- plan of the stream, and what the batches do with it ---

    def mapped(self, log: DataFrame) -> DataFrame:
        """Decoded events with their canonical struct; dead letters keep their bytes."""
        decoded = decode_events(log, keep_raw=True)
        return apply_canonical_mapping(decoded, self.spec, self.mapping_mode, self.sources).drop("canonical_payload")

    def canonical_rows(self, mapped: DataFrame, day: date | None = None) -> DataFrame:
        return expand_canonical_fields(live_events(mapped), self.spec, day or self.ingest_date)

    def write_raw(self, decoded: DataFrame, batch_id: int, day: date) -> dict:
        live = live_events(decoded).select(*self.decoded_schema.names)
        return self.raw_table.prepare_batch(raw.dated(live, day), batch_id, self.run)

    def write_canonical(self, mapped: DataFrame, batch_id: int, day: date) -> dict:
        return asdict(self.golden.prepare_batch(self.canonical_rows(mapped, day), batch_id, self.run))

    def write_warehouse(self, mapped: DataFrame, batch_id: int, day: date) -> dict:
        rows = warehouse.warehouse_rows(self.canonical_rows(mapped, day), batch_id, self.batch_timestamp, self.datetimes)
        return self.warehouse_table.prepare_batch(rows, batch_id, self.run)

    def write_dead_letters(self, decoded: DataFrame, batch_id: int) -> None:
        folder = raw.batch_folder(self.folder("dead_letters"), self.run, batch_id)
        dead_letters(decoded).write.mode("overwrite").parquet(folder)

    def staged(self, batch: DataFrame, folder: str, sinks: Sequence[str]) -> DataFrame:
        """The batch in files, with what the sinks take of it, read back.

        A cache holds thousands of whole rows as one object, and a hundred such objects while it writes them out, so wide
        rows can need more than an executor has; a writer of files needs no more for more or wider rows.  Bytes stay of
        dead letters only, and where no sink writes the id it only tells that there is one.
        """
        dead = is_dead_letter()
        if "raw" in sinks:
            rows = batch.withColumn("raw_value", F.when(dead, F.col("raw_value")))
        else:
            rows = batch.drop("payload", "raw_value", "raw_topic", "kafka_timestamp").withColumn("event_id", F.when(~dead, F.lit("")))
        rows = rows.withColumn(PLACE, F.monotonically_increasing_id())  # files are read back in any order
        rows.write.mode("overwrite").parquet(folder)
        return batch.sparkSession.read.schema(rows.schema).parquet(folder)

    def write_batch(self, batch: DataFrame, batch_id: int, sinks: Sequence[str]) -> dict[str, int]:
        """One batch into the sinks, and their record moved once: no reader sees it in some of them only.

        A batch that fails in between has moved nothing; its rows are replaced when it is repeated.
        """
        counts = self.count_rows(batch, sinks)
        if not counts["input"]:
            return counts
        commits = self.commits("_".join(s for s in SINKS if s in sinks))
        day = self.ingest_date or raw.today(self.spark)
        days = {"raw": self.raw_table, "warehouse": self.warehouse_table}
        days = {s: table for s, table in days.items() if s in sinks}
        for table in days.values():
            table.commits = commits
        self.golden.commits = commits if "canonical" in sinks else self.golden.commits
        commits.put({s: table.opened(batch_id, self.run, [day]) for s, table in days.items()})
        if counts.get("dead_letters"):
            self.write_dead_letters(batch, batch_id)
        commits.put({s: getattr(self, f"write_{s}")(batch, batch_id, day) for s in SINKS if s in sinks})
        for table in days.values():
            table.clear()
        return counts

    # --- counts ---

    def count_rows(self, batch: DataFrame, sinks: Sequence[str]) -> dict[str, int]:
        """Rows of one batch: as read, and as handed to each sink."""
        live = ~is_dead_letter()
        checks = [F.count("*").alias("input"), F.count_if(live).alias("live")]
        if "canonical" in sinks:
            no_key = reduce(or_, [F.col("canonical")[k].isNull() for k in self.spec.keys()])
            checks.append(F.count_if(live & no_key).alias("quarantine"))
        row = batch.agg(*checks).first().asDict()
        counts = {"input": row["input"]}
        if "raw" in sinks:
            counts |= {"raw": row["live"], "dead_letters": row["input"] - row["live"]}
        if "canonical" in sinks:
            counts |= {"canonical": row["live"] - row["quarantine"], "quarantine": row["quarantine"]}
        if "warehouse" in sinks:
            counts["warehouse"] = row["live"]
        return counts

    def write_counts(self, counts: dict[str, int], query: str, batch_id: int) -> None:
        """A small file for each batch, without a job; a repeated batch replaces its own."""
        folder = raw.batch_folder(f"{self.folder('counts')}/query={query}", self.run, batch_id)
        rows = "\n".join(json.dumps({"sink": sink, "n_rows": n}) for sink, n in counts.items())
        write_text(self.spark, f"{folder}/counts.json", rows + "\n")

    def read_counts(self) -> DataFrame:
        """query, _run, _batch_id, sink, n_rows: every batch ever written, none lost to a bounded history."""
        schema = f"sink string, n_rows bigint, query string, {RUN} int, {BATCH} bigint"
        return self.spark.read.schema(schema).json(self.folder("counts"))

    # --- tables ---

    @cached_property
    def decoded_schema(self) -> T.StructType:
        return decode_events(self.spark.createDataFrame([], LOG_SCHEMA)).schema

    @cached_property
    def canonical_schema(self) -> T.StructType:
        return self.canonical_rows(self.mapped(self.spark.createDataFrame([], LOG_SCHEMA))).schema

    def commits(self, name: str) -> Commits:
        """The record of the sinks that one query writes."""
        return Commits(self.spark, f"{self.root}/position/{self.spec.name}/{name}")

    def commits_of(self, sink: str) -> Commits:
        """The record that a sink obeys: that of the query that writes it."""
        names = [n for n in child_names(self.spark, f"{self.root}/position/{self.spec.name}") if sink in n.split("_")]
        if len(names) > 1:
            raise ValueError(f"sink {sink!r} is written by several queries: {names}")
        return self.commits(names[0] if names else sink)

    @cached_property
    def golden(self) -> GoldenTable:
        return GoldenTable(
            self.spark, self.folder("canonical"), self.canonical_schema, self.spec.keys(), self.mode,
            self.delete_policy, self.buckets, self.commits_of("canonical"))

    @cached_property
    def raw_table(self) -> DayTable:
        return raw.raw_table(self.spark, self.folder("raw"), self.decoded_schema, self.commits_of("raw"))

    @cached_property
    def warehouse_table(self) -> DayTable:
        empty = self.spark.createDataFrame([], self.canonical_schema)
        schema = warehouse.coerce_datetimes(empty, self.datetimes).schema
        return warehouse.warehouse_table(self.spark, self.folder("warehouse"), schema, self.commits_of("warehouse"))

    def read_raw(self, days: Sequence[date] | None = None) -> DataFrame:
        return self.raw_table.read(days)

    def read_canonical(self) -> DataFrame:
        return self.golden.read()

    def read_warehouse(self, days: Sequence[date] | None = None) -> DataFrame:
        return self.warehouse_table.read(days)

    def read_dead_letters(self) -> DataFrame:
        """Rows of the log that could not be read, with their bytes."""
        schema = dead_letters(decode_events(self.spark.createDataFrame([], LOG_SCHEMA), keep_raw=True)).schema
        folder = self.folder("dead_letters")
        if not path_exists(self.spark, folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder)

    # --- queries ---

    def start(self, log: DataFrame, sinks: Sequence[str] = SINKS, trigger: dict | None = None) -> StreamingQuery:
        """One query for the named sinks: per batch the source is read, decoded and mapped once.

        Start one query per sink instead when their triggers differ.  Errors leave the callback, so
        that a failed batch is repeated and not lost.
        """
        unknown = set(sinks) - set(SINKS)
        if unknown:
            raise ValueError(f"unknown sinks {sorted(unknown)}")
        name = "_".join(s for s in SINKS if s in sinks)
        plan = decode_events(log, keep_raw=True) if set(sinks) == {"raw"} else self.mapped(log)
        if self.dedup_delay is not None:
            plan = drop_repeated_events(plan, self.dedup_delay)
        interval = WAREHOUSE_TRIGGER if set(sinks) == {"warehouse"} else LAKE_TRIGGER

        def run_batch(batch: DataFrame, batch_id: int) -> None:
            folder = raw.batch_folder(f"{self.folder('staged')}/query={name}", self.run, batch_id)
            try:
                kept = self.staged(batch, folder, sinks)  # so no writer reads the source again
                counts = self.write_batch(kept, batch_id, sinks)
                if counts["input"]:
                    self.write_counts(counts, name, batch_id)
            finally:
                remove(self.spark, folder)

        return (
            plan.writeStream.queryName(f"{name}_{self.spec.name}_{self.run}")
            .foreachBatch(run_batch)
            .option("checkpointLocation", self.checkpoint(name))
            .trigger(**(trigger or {"processingTime": interval}))
            .start()
        )


def drop_repeated_events(decoded: DataFrame, delay: str, time_column: str = "kafka_timestamp") -> DataFrame:
    """Events whose id was already seen within ``delay`` are dropped: publishing is at-least-once.

    Dead letters have no id; they count by their place in the log and all stay.
    """
    place = F.concat_ws("-", F.lit("at"), "kafka_partition", "kafka_offset")
    marked = decoded.withColumn("_seen", F.coalesce("event_id", place)).withWatermark(time_column, delay)
    return marked.dropDuplicatesWithinWatermark(["_seen"]).drop("_seen")
