"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "_rank"
# Number of a row in its batch, where it has one: of rows that no order tells apart the first stays.
PLACE = "_place"


def event_instant(column: str = "_event_timestamp") -> Column:
    """ISO text as an instant, so that offsets spelled differently still sort by time."""
    return F.col(column).try_cast("timestamp")


def event_order(df: DataFrame, column: str = "_event_timestamp") -> list[Column]:
    """Newest first when descending: instant, then text, then the position in the log."""
    position = [F.col(c) for c in ("_partition", "_offset") if c in df.columns]
    return [event_instant(column), F.col(column), *position]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """Keep the row with the highest order per key (a null order value is the lowest).

    Spark ranks inside every input partition before the shuffle and ships one row per key and
    partition, so a key that holds most of the rows does not reach one task as a whole.
    """
    order = list(order or event_order(df))
    window = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in order])
    return df.withColumn(RANK, F.row_number().over(window)).filter(F.col(RANK) == 1).drop(RANK)


def latest_per_key_agg(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """The same rows by aggregation: the order is a struct, so null order values still compare."""
    order = list(order or event_order(df))
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return best.select(*[F.col("_row")[c].alias(c) if c in rest else F.col(c) for c in df.columns])
