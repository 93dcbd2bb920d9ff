"""Key discovery: which smallest sets of columns identify every row.

The sets form a lattice that is searched from small to large.  One pass counts nulls and estimates the distinct values of all
single columns (HyperLogLog).  A column with a null cannot be part of a key; a set whose columns' distinct values multiply
to less than the rows cannot be one; a set that holds a key is not minimal.  One more pass for each size looks at the values
in one slice of the hashes, about ``SLICE_VALUES`` of them whatever the rows are: equal values lie in one slice, so a set
that repeats a value there is no key.  Only the sets that are left are checked over all rows: by 64-bit hashes, and by the
values where a hash repeats.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unirec.functions.shared import stored

ERROR = 0.03  # relative standard deviation of the estimates
MARGIN = 4  # deviations that an estimate may be off
SETS = 64  # sets of one pass
SLICE_VALUES = 1_000_000
FOUND = "candidate string, n_columns int, n_rows bigint"

Columns = tuple[str, ...]


def _hash(columns: Columns) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def _values(df: DataFrame, sets: Sequence[Columns], wanted: Column | None = None) -> DataFrame:
    """A row for each row and set: ``set``, ``h`` (the hash) and the set's values, those of other columns null.  ``wanted`` is a
    condition on ``h``."""
    used = list(dict.fromkeys(c for s in sets for c in s))
    types = {f.name: f.dataType for f in df.schema.fields}
    rows = df.select(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(used)], *[_hash(s).alias(f"h{i}") for i, s in enumerate(sets)])

    def one(i: int, s: Columns) -> Column:
        own = [(F.col(f"v{j}") if c in s else F.lit(None).cast(types[c])).alias(f"v{j}") for j, c in enumerate(used)]
        row = F.struct(F.lit(i).alias("set"), F.col(f"h{i}").alias("h"), *own)
        return row if wanted is None else F.when(F.pmod(F.col(f"h{i}"), wanted) == 0, row)

    each = F.array(*[one(i, s) for i, s in enumerate(sets)])
    return rows.select(F.explode(each).alias("_p")).filter(F.col("_p").isNotNull()).select("_p.*")


def _repeating(values: DataFrame, sets: Sequence[Columns]) -> set[Columns]:
    """The sets with a value that two rows have."""
    columns = [c for c in values.columns if c != "h"]
    repeated = values.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1").select("set").distinct()
    return {sets[r["set"]] for r in repeated.collect()}


def without_repeats_in_slice(df: DataFrame, sets: Sequence[Columns], n: int) -> list[Columns]:
    """The sets that repeat no value in one slice of the hashes."""
    left = []
    for start in range(0, len(sets), SETS):
        part = sets[start:start + SETS]
        bad = _repeating(_values(df, part, F.lit(max(1, n // SLICE_VALUES))), part)
        left.extend(s for s in part if s not in bad)
    return left


def without_repeats(df: DataFrame, sets: Sequence[Columns]) -> list[Columns]:
    """The sets of which no two rows have the same values, over all rows; none of their columns has a null."""
    left = []
    for start in range(0, len(sets), SETS):
        part = sets[start:start + SETS]
        each = [F.struct(F.lit(i).alias("set"), _hash(s).alias("h")) for i, s in enumerate(part)]
        hashes = df.select(F.explode(F.array(*each)).alias("_p")).select("_p.*")
        twice = stored(hashes.groupBy("set", "h").agg(F.count("*").alias("n")).filter("n > 1").select("set", "h"), "repeated-hashes")
        doubtful = sorted(r["set"] for r in twice.select("set").distinct().collect())
        bad: set[Columns] = set()
        if doubtful:
            some = [part[i] for i in doubtful]
            place = F.element_at(F.array(*[F.lit(i) for i in doubtful]), F.col("set") + 1)
            rows = _values(df, some).withColumn("_set", place)
            bad = _repeating(rows.join(twice.select(F.col("set").alias("_set"), "h"), ["_set", "h"], "left_semi").drop("_set"), some)
        left.extend(s for s in part if s not in bad)
    return left


def plausible(df: DataFrame, columns: Sequence[str], most: int) -> Iterator[tuple[int, list[Columns]]]:
    """For each size the sets that may be keys.  The caller sends the keys among them back, so that no larger set holds one."""
    checks = [F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)]
    sketches = [F.approx_count_distinct(_hash((c,)), ERROR).alias(f"d{i}") for i, c in enumerate(columns)]
    row = df.agg(F.count("*").alias("n"), *checks, *sketches).first()
    n = row["n"]
    usable = [c for i, c in enumerate(columns) if n and row[f"c{i}"] == n]
    least, slack = n * (1 - MARGIN * ERROR), 1 + MARGIN * ERROR
    distinct = {c: row[f"d{i}"] for i, c in enumerate(columns)}
    keys: list[set[str]] = []
    for size in range(1, min(most, len(usable)) + 1):
        sets = [
            s for s in combinations(usable, size)
            if math.prod(min(distinct[c] * slack, n) for c in s) >= n and not any(k <= set(s) for k in keys)]
        if size == 1:
            sets = [s for s in sets if distinct[s[0]] >= least]
        found = yield size, without_repeats_in_slice(df, sets, n)
        keys.extend(set(s) for s in found or [])


def discover_merge_keys(df: DataFrame, columns: Sequence[str] | None = None, most: int = 3) -> DataFrame:
    """``candidate`` (names joined by ``+``), ``n_columns``, ``n_rows``: every minimal key of at most ``most`` columns."""
    columns = list(columns or df.columns)
    found, search = [], plausible(df, columns, most)
    step = next(search, None)
    while step is not None:
        size, sets = step
        keys = without_repeats(df, sets)
        found.extend(("+".join(s), size) for s in keys)
        try:
            step = search.send(keys)
        except StopIteration:
            step = None
    n = df.count() if found else 0
    return df.sparkSession.createDataFrame([(*f, n) for f in found], FOUND)


def best_key(found: DataFrame) -> list[str] | None:
    """The columns of the key with the fewest columns; of equal ones the first by name."""
    row = found.orderBy("n_columns", "candidate").first()
    return row["candidate"].split("+") if row else None
