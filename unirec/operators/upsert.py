"""Keyed upsert as joins, for tables without row-level operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unirec.operators.latest import event_order, latest_per_key

ARRIVAL = "arrival"
EVENT_TIME = "event_time"
DELETE_POLICIES = ("keep", "tombstone", "remove")
DELETED = "_deleted"


def has_null_key(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that can be merged, rows to quarantine): a null key never matches anything."""
    return df.filter(~has_null_key(keys)), df.filter(has_null_key(keys))


def mark_deleted(df: DataFrame, delete_policy: str) -> DataFrame:
    """Add the tombstone column unless deletes are kept as plain rows."""
    if delete_policy not in DELETE_POLICIES:
        raise ValueError(f"delete_policy must be one of {DELETE_POLICIES}, got {delete_policy!r}")
    if delete_policy == "keep" or DELETED in df.columns:
        return df
    return df.withColumn(DELETED, F.coalesce(F.col("_event_type") == "DELETE", F.lit(False)))


def visible_rows(df: DataFrame, delete_policy: str) -> DataFrame:
    """Apply the policy on read: ``remove`` hides the tombstones that the table keeps."""
    if delete_policy == "remove" and DELETED in df.columns:
        return df.filter(~F.col(DELETED)).drop(DELETED)
    return df


def replace_rows(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changed keys replaced or added as whole rows, all other rows untouched.

    ``changes`` has one row per key.  The anti join needs only its keys, and AQE broadcasts them when
    their measured size allows; a target bucketed by the keys is not shuffled either way.
    """
    untouched = target.join(changes.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(changes.select(*target.columns))


def replace_newer(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None,
) -> DataFrame:
    """As ``replace_rows``, but a change only wins when its order is higher than the target's.

    Both sides have one row per key, so the full outer join gives at most one row per key.
    """
    def rank(df: DataFrame) -> Column:
        chosen = list(order or event_order(df))
        return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(chosen)])

    columns = target.columns
    row = F.struct(*columns)
    old = target.select(*keys, row.alias("_old"), rank(target).alias("_old_rank"))
    new = changes.select(*keys, row.alias("_new"), rank(changes).alias("_new_rank"))
    both = old.join(new, list(keys), "full_outer")
    change_wins = F.col("_old").isNull() | F.coalesce(F.col("_new_rank") > F.col("_old_rank"), F.lit(False))
    return both.select(F.when(change_wins, F.col("_new")).otherwise(F.col("_old")).alias("_row")).select("_row.*")


def overlay_rows(base: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[Column] | None) -> DataFrame:
    """Changes laid over a base, both with one row per key.  A change wins by arrival (``order`` is None) or when its order
    is higher.  The changes of a partition are hashed and the base passes by: a base that is dealt by the keys is neither
    shuffled nor sorted."""
    columns = base.columns

    def sided(df: DataFrame, side: str) -> DataFrame:
        rank = [] if order is None else [F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias(f"_{side}_rank")]
        return df.select(*keys, F.struct(*columns).alias(f"_{side}"), *rank)

    both = sided(base, "old").join(sided(changes, "new").hint("shuffle_hash"), list(keys), "full_outer")
    wins = F.col("_new").isNotNull()
    if order is not None:
        wins &= F.col("_old").isNull() | F.coalesce(F.col("_new_rank") > F.col("_old_rank"), F.lit(False))
    return both.select(F.when(wins, F.col("_new")).otherwise(F.col("_old")).alias("_row")).select("_row.*")


def upsert(
    target: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    mode: str = ARRIVAL,
    order: Sequence[Column] | None = None,
    delete_policy: str = "keep",
) -> DataFrame:
    """One batch merged into a target; rows with a null key are left to ``split_null_keys``.

    ``arrival``: the batch's newest row per key replaces the target's row, whatever its time.
    ``event_time``: it does so only when it is newer; any order and split of the input gives one
    result, provided that the target keeps its tombstones.

    ``keep`` treats a DELETE as a plain row, ``tombstone`` marks it in ``_deleted``, ``remove`` hides
    it from the result.
    """
    if mode not in (ARRIVAL, EVENT_TIME):
        raise ValueError(f"mode must be {ARRIVAL!r} or {EVENT_TIME!r}, got {mode!r}")
    if mode == EVENT_TIME and delete_policy == "remove" and target is not None and DELETED not in target.columns:
        raise ValueError(f"a target without {DELETED} has lost its tombstones: late events would revive rows; "
                         "keep the table under 'tombstone' and hide them with visible_rows")
    usable = mark_deleted(split_null_keys(batch, keys)[0], delete_policy)
    changes = latest_per_key(usable, keys, order)
    if target is None:
        return visible_rows(changes, delete_policy)
    marked = mark_deleted(target, delete_policy)
    merged = (
        replace_rows(marked, changes, keys) if mode == ARRIVAL
        else replace_newer(marked, changes, keys, order)
    )
    return visible_rows(merged, delete_policy)


def merge_into_catalog(
    batch: DataFrame,
    table: str,
    keys: Sequence[str],
    mode: str = ARRIVAL,
    order: Sequence[Column] | None = None,
) -> None:
    """The same upsert by ``MERGE``, where the catalogue of ``table`` supports row-level operations.

    Deletes are plain rows here; null keys are left out.
    """
    usable, _ = split_null_keys(batch, keys)
    changes = latest_per_key(usable, keys, order).alias("s")
    match = reduce(and_, [F.expr(f"{table}.{k} = s.{k}") for k in keys])
    merge = changes.mergeInto(table, match)
    newer = None
    if mode == EVENT_TIME:
        # A time that is missing or cannot be read is the lowest, on either side.
        new, old = (f"try_cast({side}._event_timestamp AS timestamp)" for side in ("s", table))
        newer = F.expr(f"{new} IS NOT NULL AND ({old} IS NULL OR {new} > {old})")
    merge.whenMatched(newer).updateAll().whenNotMatched().insertAll().merge()
