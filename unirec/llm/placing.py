"""Running totals over a table that no single task can hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from unirec.functions.shared import stored


def with_running_total(df: DataFrame, group: list[str], order: list[str], measure: str, out: str, name: str) -> DataFrame:
    """Adds ``out``: the sum of ``measure`` over the rows of the same group that come before, by ``order``.

    Rows are dealt by ranges of (group, order), so a hot group spreads over many tasks; each range is summed for
    itself and then gets the sum of the ranges before it (one row per range and group).  The dealt rows are
    stored first, so the ranges do not move when a task is run again.  Group columns must not be null; equal rows
    are interchangeable.
    """
    keys = [*group, *order]
    dealt = df.repartitionByRange(*keys) if keys else df
    placed = stored(
        dealt.sortWithinPartitions(*keys).withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}), name)
    ahead = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part", *group).agg(F.sum(measure).alias("_sum"))
    parts = parts.select("_part", *group, F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part", *group).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("_in", F.coalesce(F.sum(measure).over(inside), F.lit(0)))
        .join(parts, ["_part", *group])
        .withColumn(out, (F.col("_in") + F.col("_before")).cast("long"))
        .drop("_part", "_row", "_in", "_before")
    )
