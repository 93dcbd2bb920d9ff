"""Counts and summaries over events, tables and catalogues."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_counts(events: DataFrame) -> DataFrame:
    """Events per entity, source and event type."""
    return events.groupBy("entity", "source", "event_type").agg(F.count("*").alias("n_events"))


def catalog_summary(catalog: DataFrame) -> DataFrame:
    """Tables, columns and rows per source of a column catalogue."""
    per_table = catalog.groupBy("source", "table").agg(
        F.count("*").alias("n_columns"), F.max("row_count").alias("row_count"))
    return per_table.groupBy("source").agg(
        F.count("*").alias("n_tables"),
        F.sum("n_columns").alias("n_columns"),
        F.sum("row_count").alias("n_rows"),
    )


def pipeline_summary(catalog: DataFrame, matches: DataFrame, models: DataFrame, events: DataFrame, errors: DataFrame) -> DataFrame:
    """item, n: the state of a whole pipeline.  Tables of each source, entities that were matched, canonical models and their
    fields, topics and events, and errors by reason."""
    def counted(df: DataFrame, item: Column) -> DataFrame:
        return df.groupBy(item.alias("item")).agg(F.count("*").alias("n"))

    def total(df: DataFrame, item: str) -> DataFrame:
        return df.agg(F.count("*").alias("n")).select(F.lit(item).alias("item"), "n")

    tables = counted(catalog.select("source", "table").distinct(), F.concat("source", F.lit(" tables")))
    parts = [
        tables, total(matches, "entity matches"), total(models.select("canonical_name").distinct(), "canonical models"),
        total(models, "canonical fields"), total(events.select("entity").filter("entity IS NOT NULL").distinct(), "topics"),
        total(events.filter("event_id IS NOT NULL"), "events"), counted(errors, F.concat(F.lit("errors: "), F.col("reason"))),
    ]
    return reduce(DataFrame.unionByName, parts)
