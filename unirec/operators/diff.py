"""Difference of two snapshots as change rows, for sources without a change timestamp."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unirec.operators.latest import latest_per_key
from unirec.operators.upsert import split_null_keys


def snapshot_diff(
    old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None,
) -> DataFrame:
    """``event_type`` (INSERT / UPDATE / DELETE), the row, and ``before`` (null for INSERT).

    A DELETE carries the old row.  Unchanged rows give nothing.  Should a snapshot repeat a key, its
    highest row counts; the step shares its shuffle with the join and keeps a hot key from meeting
    itself in all pairs.
    """
    columns = old.columns
    order = list(order or [F.col(c) for c in columns if c not in keys] or [F.lit(1)])
    row = F.struct(*columns)

    def one_per_key(df: DataFrame, name: str) -> DataFrame:
        usable, _ = split_null_keys(df.select(*columns), keys)
        return latest_per_key(usable, keys, order).select(*keys, row.alias(name))

    both = one_per_key(old, "before").join(one_per_key(new, "after"), list(keys), "full_outer")
    same = reduce(and_, [F.col("before")[c].eqNullSafe(F.col("after")[c]) for c in columns])
    kind = (
        F.when(F.col("before").isNull(), "INSERT")
        .when(F.col("after").isNull(), "DELETE")
        .when(~same, "UPDATE")
    )
    changed = both.select(
        kind.alias("event_type"),
        F.coalesce("after", "before").alias("_row"),
        "before",
    ).filter(F.col("event_type").isNotNull())
    return changed.select("event_type", "_row.*", "before")
