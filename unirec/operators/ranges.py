"""Key ranges: bounds that cut a table by a key, and snapshots whose ranges carry digests.

A stored snapshot has a folder for each key range and a summary table with the count and two hashes of each range's rows.  Two
snapshots with the same bounds are compared by their summaries, and only ranges that differ are read and joined.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unirec.functions.shared import path_exists, read_state, write_state
from unirec.operators.diff import snapshot_diff

RANGE = "_range"
SAMPLE_PER_RANGE = 100


def key_bounds(df: DataFrame, key: str, ranges: int) -> list[str]:
    """At most ``ranges - 1`` bounds as text, from a sample of the keys (``SAMPLE_PER_RANGE`` for each range): they decide how
    even the ranges are, not what belongs to them."""
    if ranges < 2:
        return []
    keys = df.select(F.col(key).alias("k")).filter("k IS NOT NULL")
    sample = keys.orderBy(F.xxhash64("k"), "k").limit(ranges * SAMPLE_PER_RANGE)
    texts = [r[0] for r in sample.orderBy("k").select(F.col("k").cast("string")).collect()]
    picks = [texts[len(texts) * i // ranges] for i in range(1, ranges)] if texts else []
    return list(dict.fromkeys(picks))


def range_number(key: Column, dtype: T.DataType, bounds: Sequence[str]) -> Column:
    """The number of bounds below the key; null keys are in range 0."""
    if not bounds:
        return F.lit(0)
    typed = F.array(*[F.lit(b) for b in bounds]).cast(T.ArrayType(dtype))
    return F.coalesce(F.size(F.filter(typed, lambda b: b < key)), F.lit(0))


def in_range(key: Column, dtype: T.DataType, bounds: Sequence[str], number: int) -> Column:
    """As a comparison with literals, which a source can be asked for."""
    low = F.lit(bounds[number - 1]).cast(dtype) if number else None
    high = F.lit(bounds[number]).cast(dtype) if number < len(bounds) else None
    inside = F.lit(True) if high is None else key <= high
    return (inside | key.isNull()) if low is None else (inside & (key > low))


class SnapshotStore:
    """Snapshots of one table below ``path``; the bounds are chosen with the first and belong to the store."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], ranges: int = 64) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.keys = list(keys)
        self.ranges = ranges

    def _bounds(self, df: DataFrame | None = None) -> list[str]:
        text = read_state(self.spark, f"{self.path}/bounds")
        if text is None:
            bounds = key_bounds(df, self.keys[0], self.ranges)
            write_state(self.spark, f"{self.path}/bounds", json.dumps(bounds))
            return bounds
        return json.loads(text)

    def write(self, df: DataFrame, version: str) -> None:
        """Store a snapshot and its summary; a version that is written again replaces itself.  The ranges are dealt with a
        part of the key's hash, so a large one is not one task's."""
        number = range_number(F.col(self.keys[0]), self.schema[self.keys[0]].dataType, self._bounds(df))
        rows = df.select(*self.schema.names).withColumn(RANGE, number)
        slot = F.pmod(F.xxhash64(*self.keys), F.lit(8))
        rows.repartition(RANGE, slot).write.mode("overwrite").partitionBy(RANGE).parquet(self._rows_path(version))
        digest = F.xxhash64(*[_plain(f) for f in self.schema.fields])
        summary = self._stored(version).groupBy(RANGE).agg(
            F.count("*").alias("n_rows"), F.bit_xor(digest).alias("mixed"), F.sum(digest.cast("decimal(38,0)")).alias("total"))
        summary.coalesce(1).write.mode("overwrite").parquet(self._summary_path(version))

    def _rows_path(self, version: str) -> str:
        return f"{self.path}/rows/version={version}"

    def _summary_path(self, version: str) -> str:
        return f"{self.path}/summary/version={version}"

    def _stored(self, version: str) -> DataFrame:
        if not path_exists(self.spark, self._rows_path(version)):
            raise ValueError(f"no snapshot {version!r}")
        full = T.StructType([*self.schema.fields, T.StructField(RANGE, T.IntegerType())])
        return self.spark.read.schema(full).parquet(self._rows_path(version))

    def read(self, version: str, ranges: Sequence[int] | None = None) -> DataFrame:
        rows = self._stored(version)
        return (rows if ranges is None else rows.filter(F.col(RANGE).isin(list(ranges)))).drop(RANGE)

    def changed_ranges(self, old: str, new: str) -> list[int]:
        """Numbers of the ranges whose digests differ; one row per range and version is read."""
        one, two = (self.spark.read.parquet(self._summary_path(v)) for v in (old, new))
        columns = ["n_rows", "mixed", "total"]
        both = one.select(RANGE, F.struct(*columns).alias("a")).join(two.select(RANGE, F.struct(*columns).alias("b")), RANGE, "full_outer")
        return sorted(r[0] for r in both.filter(~F.col("a").eqNullSafe(F.col("b"))).select(RANGE).collect())

    def diff(self, old: str, new: str) -> DataFrame:
        """``snapshot_diff`` of two versions, worked out in the ranges that differ."""
        changed = self.changed_ranges(old, new)
        return snapshot_diff(self.read(old, changed), self.read(new, changed), self.keys)


def _plain(field: T.StructField) -> Column:
    """A column as something that has a hash, null apart from every value."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.VariantType):
        value = F.to_json(value)
    return F.struct(value.isNull().alias("none"), value.alias("value"))
