"""One golden record from many sources, field by field.

A state has one row per key and source.  It holds, for every field, the newest value that is not null and the rank of the
event it came from, the rank of the newest event, and of the newest delete.  Two states of the same rows merge by keeping
the higher rank field by field, so batches merge in any order, in any grouping and more than once.

The record of a key takes each field from the first source of the rule that has a value, or, for the fields named in
``newest``, from the newest value of any source.  A delete withdraws what its source said before; a key goes when all
its sources have deleted it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unirec.operators.latest import event_order

SEEN, GONE = "_seen", "_gone"


@dataclass(frozen=True)
class Survivorship:
    """``sources`` from the most trusted to the least; sources not named come after them, the newest value first."""

    keys: tuple[str, ...]
    fields: tuple[str, ...]
    sources: tuple[str, ...] = ()
    newest: tuple[str, ...] = ()
    source: str = "_source"
    time: str = "_event_timestamp"

    def state_keys(self) -> list[str]:
        return [*self.keys, self.source]


def event_rank(events: DataFrame, rule: Survivorship) -> Column:
    """Instant, text and place of an event."""
    return F.struct(*[c.alias(f"r{i}") for i, c in enumerate(event_order(events, rule.time))])


def with_tie(rank: Column, value: Column) -> Column:
    """Values of one rank that differ are told apart by their text, so that no order of merging matters."""
    return F.struct(rank.alias("rank"), F.coalesce(value.cast("string"), F.lit("")).alias("tie"))


def newest_columns(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: of every other column, a struct with ``place``, the value with the highest place."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*[F.max_by(c, F.col(c)["place"]).alias(c) for c in rest]).select(*rows.columns)


def newer_column(old: Column, new: Column) -> Column:
    wins = old.isNull() | F.coalesce(new["place"] > old["place"], F.lit(False))
    return F.when(wins & new.isNotNull(), new).otherwise(old)


def field_states(events: DataFrame, rule: Survivorship) -> DataFrame:
    """The state of a batch of canonical events."""
    rank, deleted = event_rank(events, rule), F.coalesce(F.col("_event_type") == "DELETE", F.lit(False))

    def held(value: Column, counts: Column) -> Column:
        return F.when(counts, F.struct(with_tie(rank, value).alias("place"), value.alias("value")))

    columns = [held(F.col(f), F.col(f).isNotNull() & ~deleted).alias(f) for f in rule.fields]
    seen = held(F.col(rule.time), ~deleted).alias(SEEN)
    gone = held(F.col(rule.time), deleted).alias(GONE)
    return newest_columns(events.select(*rule.state_keys(), *columns, seen, gone), rule.state_keys())


def merge_states(one: DataFrame, two: DataFrame, rule: Survivorship) -> DataFrame:
    return newest_columns(one.unionByName(two), rule.state_keys())


def _chosen(states: DataFrame, rule: Survivorship) -> DataFrame:
    """Keys, and per field a struct of value, source and time."""
    def stands(column: Column) -> Column:
        """Not withdrawn by a later delete of the same source."""
        return column.isNotNull() & F.coalesce(column["place"]["rank"] > F.col(GONE)["place"]["rank"], F.lit(True))

    named = F.array(*[F.lit(s) for s in rule.sources]).cast("array<string>")
    place = F.array_position(named, F.col(rule.source))
    trust = F.when(place > 0, -place).otherwise(F.lit(-(len(rule.sources) + 1)))
    live = states.withColumn("_live", stands(F.col(SEEN)))
    picks = []
    for name in rule.fields:
        column = F.col(name)
        order = [column["place"], trust] if name in rule.newest else [trust, column["place"]]
        order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate([*order, F.col(rule.source)])])
        value = F.struct(column["value"].alias("value"), F.col(rule.source).alias("source"), column["place"]["rank"]["r1"].alias("time"))
        picks.append(F.max_by(value, F.when(F.col("_live") & stands(column), order)).alias(name))
    found = live.groupBy(*rule.keys).agg(*picks, F.max("_live").alias("_live"))
    return found.filter("_live").drop("_live")


def golden_records(states: DataFrame, rule: Survivorship) -> DataFrame:
    """keys and fields: one row per key that some source still has."""
    return _chosen(states, rule).select(*rule.keys, *[F.col(f)["value"].alias(f) for f in rule.fields])


def provenance(states: DataFrame, rule: Survivorship) -> DataFrame:
    """keys, field, source, time: where each value of the golden record comes from; null where it has none."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f)["source"].alias("source"), F.col(f)["time"].alias("time")) for f in rule.fields])
    return _chosen(states, rule).select(*rule.keys, F.explode(each).alias("_p")).select(*rule.keys, "_p.*")
