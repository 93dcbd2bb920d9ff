"""Canonical table without row-level operations: a change log, a base in buckets, and a view over both.

Every batch adds its newest row per key to the log, in a folder of its own, so a replayed batch replaces itself.  A key
belongs to one of N buckets, and each bucket of the base has a version of its own.  Reading lays the log over the base, but
only in the buckets that have changes; the others are read as they are.  ``compact`` writes new versions of changed buckets
and leaves the files of all others alone.  The overlay hashes the changes of a bucket and streams its base past them:
the base is neither shuffled nor sorted.

    <path>/changes/_run=R/_batch_id=B/       rows of one batch
    <path>/quarantine/_run=R/_batch_id=B/    rows with a null key, where a batch has any
    <path>/base/v=V/_bucket=K/               version V of bucket K, sorted by the keys
    <path>/position/                         the manifest: the last batch, and for each bucket its version, the batch it
                                             is folded through, and whether it has changes beyond (or a record that the
                                             table shares with other sinks)

The manifest is one small file, so neither writing nor reading walks the folders of past batches, and a batch or
compaction counts when the manifest has moved to it.  A compaction removes what the one before it had replaced and folded;
readers of the last manifest go on.  The number of buckets belongs to the table and not to the session; ``rebucket`` changes
it.  A bucket's changes must fit a task's memory: compact before they do not.

One writer at a time: batches and compactions of a table must not overlap.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unirec.functions.shared import child_names, path_exists, remove
from unirec.operators.latest import PLACE, event_order, latest_per_key
from unirec.operators.survivorship import Survivorship, field_states, golden_records, newer_column
from unirec.operators.upsert import (
    ARRIVAL, DELETE_POLICIES, DELETED, EVENT_TIME, has_null_key, mark_deleted, overlay_rows, split_null_keys, visible_rows,
)
from unirec.sinks.commits import Commits
from unirec.sinks.raw import batch_folder

RUN, BATCH, BUCKET = "_run", "_batch_id", "_bucket"
SECTION = "canonical"

Batch = tuple[int, int]


@dataclass(frozen=True)
class Manifest:
    """State of the table.  Per bucket: its base version (0: none yet) and the place of its fold among ``folds``."""

    buckets: int
    batch: Batch | None = None
    version: int = 0
    bases: tuple[int, ...] = ()
    folds: tuple[Batch | None, ...] = (None,)
    fold_of: tuple[int, ...] = ()
    hit: tuple[int, ...] = ()  # buckets with changes beyond their fold
    replaced: tuple[tuple[int, int], ...] = field(default=())  # (version, bucket) that the last compaction left behind

    @classmethod
    def new(cls, buckets: int) -> Manifest:
        return cls(buckets, bases=(0,) * buckets, fold_of=(0,) * buckets)

    @classmethod
    def from_section(cls, raw: dict) -> Manifest:
        pairs = {k: tuple(tuple(x) if x is not None else None for x in raw[k]) for k in ("folds", "replaced")}
        lists = {k: tuple(raw[k]) for k in ("bases", "fold_of", "hit")}
        return cls(**raw | pairs | lists | {"batch": tuple(raw["batch"]) if raw["batch"] else None})

    def fold(self, bucket: int) -> Batch | None:
        return self.folds[self.fold_of[bucket]]

    def compacted(self, chosen: Sequence[int]) -> Manifest:
        """After new versions of the ``chosen`` buckets: they, and all buckets without changes, are folded through the last
        batch; buckets with changes that were not chosen stay where they are."""
        taken = set(chosen)
        left = set(self.hit) - taken
        folds = {b: self.batch if b not in left else self.fold(b) for b in range(self.buckets)}
        places = sorted(set(folds.values()), key=lambda f: f or (-1, -1))
        version = self.version + 1
        bases = [version if b in taken else v for b, v in enumerate(self.bases)]
        return replace(
            self, version=version, bases=tuple(bases), folds=tuple(places), fold_of=tuple(places.index(folds[b]) for b in range(self.buckets)),
            hit=tuple(sorted(left)), replaced=tuple((self.bases[b], b) for b in sorted(taken) if self.bases[b]))


class GoldenTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        mode: str = ARRIVAL,
        delete_policy: str = "keep",
        buckets: int | None = None,
        commits: Commits | None = None,
    ) -> None:
        if mode not in (ARRIVAL, EVENT_TIME):
            raise ValueError(f"mode must be {ARRIVAL!r} or {EVENT_TIME!r}, got {mode!r}")
        if delete_policy not in DELETE_POLICIES:
            raise ValueError(f"delete_policy must be one of {DELETE_POLICIES}, got {delete_policy!r}")
        self.spark = spark
        self.path = path.rstrip("/")
        self.commits = commits or Commits(spark, f"{self.path}/position")
        self.keys = list(keys)
        self.mode = mode
        self.delete_policy = delete_policy
        self._first_buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        fields = list(schema.fields)
        if delete_policy != "keep":
            fields.append(T.StructField(DELETED, T.BooleanType()))
        self.schema = T.StructType(fields)
        self.base_schema = T.StructType([
            *fields, T.StructField(RUN, T.IntegerType()), T.StructField(BATCH, T.LongType())])

    # --- manifest ---

    def manifest(self) -> Manifest:
        section = self.commits.get(SECTION)
        return Manifest.from_section(section) if section else Manifest.new(self._first_buckets)

    def _move_to(self, manifest: Manifest) -> None:
        self.commits.put({SECTION: asdict(manifest)})

    def last_batch(self) -> Batch | None:
        """Highest (run, batch) that was written completely."""
        return self.manifest().batch

    def _bucket(self, buckets: int) -> Column:
        """The bucket of a key, by the hash that Spark's own bucketing uses."""
        return F.pmod(F.hash(*self.keys), F.lit(buckets))

    # --- writing ---

    def write_batch(self, batch: DataFrame, batch_id: int, run: int = 0) -> None:
        """Add one batch.  ``run`` must be raised when a stream starts from a fresh checkpoint."""
        self._move_to(self.prepare_batch(batch, batch_id, run))

    def prepare_batch(self, batch: DataFrame, batch_id: int, run: int = 0) -> Manifest:
        """Write the files of a batch and return the manifest that makes it count."""
        now = self.manifest()
        self._check_position(now, run, batch_id)
        nulls, hits = Observation(), Observation()
        read = batch.observe(nulls, F.count_if(has_null_key(self.keys)).alias("n"))
        usable, _ = split_null_keys(read, self.keys)
        changes = self._newest(usable).select(*self.schema.names).observe(hits, F.collect_set(self._bucket(now.buckets)).alias("hit"))
        changes.write.mode("overwrite").parquet(batch_folder(f"{self.path}/changes", run, batch_id))
        aside = batch_folder(f"{self.path}/quarantine", run, batch_id)
        if nulls.get["n"]:
            split_null_keys(batch.drop(PLACE), self.keys)[1].write.mode("overwrite").parquet(aside)
        elif now.batch == (run, batch_id):
            remove(self.spark, aside)
        beyond = {b for b in hits.get["hit"] if now.fold(b) is None or now.fold(b) < (run, batch_id)}
        return replace(now, batch=(run, batch_id), hit=tuple(sorted(beyond | set(now.hit))))

    # What the tables differ in: the row of a key that stays inside a batch, in the log, and over the base.

    def _newest(self, batch: DataFrame) -> DataFrame:
        first = [-F.col(PLACE)] if PLACE in batch.columns else []
        return latest_per_key(mark_deleted(batch, self.delete_policy), self.keys, [*event_order(batch), *first])

    def _newest_change(self, log: DataFrame) -> DataFrame:
        return latest_per_key(log, self.keys, self._order(log))

    def _overlay(self, base: DataFrame, changes: DataFrame) -> DataFrame:
        order = None if self.mode == ARRIVAL else self._order(base)
        return overlay_rows(base, changes, self.keys, order)

    @staticmethod
    def _check_position(now: Manifest, run: int, batch_id: int) -> None:
        """A batch may repeat the last one or follow it; anything older would rewrite history."""
        if now.batch is not None and (run, batch_id) < now.batch:
            raise ValueError(
                f"batch {batch_id} of run {run} is older than {now.batch}: raise `run` after a fresh checkpoint")

    # --- reading ---

    def _base(self, now: Manifest) -> DataFrame:
        """The base as a bucketed table whose partitions are the buckets' current versions, registered in the session when
        it is not yet known."""
        name = _table_name("base", f"{self.path}@{now.version}")
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.base_schema.fields)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}, {BUCKET} int) USING parquet PARTITIONED BY ({BUCKET}) "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {now.buckets} BUCKETS LOCATION '{self.path}/base'")
            places = " ".join(f"PARTITION ({BUCKET}={b}) LOCATION '{self._bucket_location(v, b)}'" for b, v in enumerate(now.bases) if v)
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")
        return self.spark.table(name)

    def _bucket_location(self, version: int, bucket: int) -> str:
        return f"{self.path}/base/v={version}/{BUCKET}={bucket}"

    def _changes(self, now: Manifest, buckets: Sequence[int]) -> DataFrame:
        """The newest change per key beyond the fold of its bucket, one partition for each bucket."""
        log = self.spark.read.schema(self.base_schema).parquet(f"{self.path}/changes")
        log = log.withColumn(BUCKET, self._bucket(now.buckets))
        position = F.struct(F.col(RUN), F.col(BATCH))
        wanted = F.lit(False)
        for place in sorted({now.fold_of[b] for b in buckets}):
            mine = [b for b in buckets if now.fold_of[b] == place]
            # A filter on the position prunes the folders of folded batches.
            beyond = F.lit(True) if now.folds[place] is None else position > _pair(now.folds[place])
            wanted = wanted | (beyond & F.col(BUCKET).isin(mine))
        first = [now.folds[now.fold_of[b]] for b in buckets]
        if None not in first:
            log = log.filter(position > _pair(min(first)))
        log = log.filter(position <= _pair(now.batch)).filter(wanted).repartition(now.buckets, *self.keys)
        return self._newest_change(log.drop(BUCKET))

    def _order(self, df: DataFrame) -> list[Column]:
        arrival = [F.col(RUN), F.col(BATCH)]
        return arrival if self.mode == ARRIVAL else [*event_order(df), *arrival]

    def _rows(self, now: Manifest, buckets: Sequence[int]) -> DataFrame:
        """Base and changes of the named buckets, which have changes."""
        changes = self._changes(now, buckets)
        if not any(now.bases[b] for b in buckets):
            return changes
        base = self._base(now)
        if len(buckets) < now.buckets:
            base = base.filter(F.col(BUCKET).isin(list(buckets)))
        return self._overlay(base.drop(BUCKET), changes)

    def _all_rows(self, now: Manifest) -> DataFrame:
        if now.batch is None:
            return self.spark.createDataFrame([], self.base_schema)
        hit = set(now.hit)
        still = any(v for b, v in enumerate(now.bases) if b not in hit)
        parts = [self._rows(now, now.hit)] if now.hit else []
        if still:
            base = self._base(now)
            parts.append(base.filter(~F.col(BUCKET).isin(list(now.hit))) if now.hit else base)
        if not parts:
            return self.spark.createDataFrame([], self.base_schema)
        rows = [p.select(*self.base_schema.names) for p in parts]
        return rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])

    def read(self) -> DataFrame:
        """Current rows under the table's delete policy."""
        return self.read_at(self.manifest())

    def read_at(self, manifest: Manifest) -> DataFrame:
        """The rows as of a manifest; its files last until the compaction after the next one."""
        return visible_rows(self._all_rows(manifest).drop(RUN, BATCH), self.delete_policy)

    def quarantine(self) -> DataFrame:
        path = f"{self.path}/quarantine"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], self.base_schema)
        return self.spark.read.schema(self.base_schema).parquet(path)

    # --- compaction ---

    def changes_per_bucket(self) -> DataFrame:
        """_bucket, n_changes: keys with changes beyond the fold, to choose buckets to compact by."""
        now = self.manifest()
        if not now.hit:
            return self.spark.createDataFrame([], f"{BUCKET} int, n_changes bigint")
        rows = self._changes(now, now.hit).withColumn(BUCKET, self._bucket(now.buckets))
        return rows.groupBy(BUCKET).agg(F.count("*").alias("n_changes"))

    def compact(self, buckets: Iterable[int] | None = None) -> None:
        """Fold the changes of the named buckets (None: of all that have any) into new versions of them.  Tombstones stay, so
        that late events cannot revive a row."""
        now, wanted = self.manifest(), None if buckets is None else set(buckets)
        chosen = [b for b in now.hit if wanted is None or b in wanted]
        if not chosen:
            return
        after = now.compacted(chosen)
        self._write_base(self._rows(now, chosen), now.buckets, after.version)
        self._move_to(after)
        self._forget(now, after)

    def rebucket(self, buckets: int) -> None:
        """Write the whole table anew in another number of buckets."""
        now = self.manifest()
        if now.batch is None or buckets == now.buckets:
            self._first_buckets = buckets
            return
        version = now.version + 1
        self._write_base(self._all_rows(now).repartition(buckets, *self.keys), buckets, version)
        made = {int(n.split("=")[1]) for n in child_names(self.spark, f"{self.path}/base/v={version}") if n.startswith(f"{BUCKET}=")}
        after = Manifest(
            buckets, now.batch, version, tuple(version if b in made else 0 for b in range(buckets)), (now.batch,), (0,) * buckets,
            replaced=tuple((v, b) for b, v in enumerate(now.bases) if v))
        self._move_to(after)
        self._forget(now, after)

    def _write_base(self, rows: DataFrame, buckets: int, version: int) -> None:
        """A folder for each bucket.  The rows come one partition for each bucket, so each gets one file."""
        location = f"{self.path}/base/v={version}"
        name = _table_name("write", location)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        (rows.select(*self.base_schema.names).withColumn(BUCKET, self._bucket(buckets).cast("int"))
         .write.mode("overwrite").option("path", location)
         .partitionBy(BUCKET).bucketBy(buckets, *self.keys).sortBy(*self.keys).saveAsTable(name))
        self.spark.sql(f"DROP TABLE {name}")  # external: the files stay

    def _forget(self, before: Manifest, after: Manifest) -> None:
        """Remove the bucket versions that the compaction before this one replaced, and the batches that it had folded in
        every bucket."""
        for version, bucket in before.replaced:
            remove(self.spark, self._bucket_location(version, bucket))
        live = {v for v in (*before.bases, *after.bases)} | {v for v, _ in after.replaced}
        for name in child_names(self.spark, f"{self.path}/base"):
            if name.startswith("v=") and int(name[2:]) not in live:
                remove(self.spark, f"{self.path}/base/{name}")
        for old in range(max(before.version - 1, 0), before.version):
            self.spark.sql(f"DROP TABLE IF EXISTS {_table_name('base', f'{self.path}@{old}')}")
        if any(before.fold(b) is None for b in before.hit) or None in before.folds:
            return
        through = min(before.folds)
        for run in (n for n in child_names(self.spark, f"{self.path}/changes") if n.startswith(f"{RUN}=")):
            folder = f"{self.path}/changes/{run}"
            for batch in child_names(self.spark, folder):
                if batch.startswith(f"{BATCH}=") and (int(run.split("=")[1]), int(batch.split("=")[1])) <= through:
                    remove(self.spark, f"{folder}/{batch}")


class SurvivorshipTable(GoldenTable):
    """Field states of an entity, stored as a golden table is: a row per key and source, of which every column is the
    newest of its own.  Batches of canonical events come in any order."""

    def __init__(self, spark: SparkSession, path: str, events: T.StructType, rule: Survivorship, buckets: int | None = None) -> None:
        self.rule = rule
        states = field_states(spark.createDataFrame([], events), rule).schema
        super().__init__(spark, path, states, rule.state_keys(), buckets=buckets)

    def write_events(self, events: DataFrame, batch_id: int, run: int = 0) -> None:
        self.write_batch(field_states(events, self.rule), batch_id, run)

    def records(self) -> DataFrame:
        return golden_records(self.read(), self.rule)

    def _newest(self, batch: DataFrame) -> DataFrame:
        return batch

    def _newest_change(self, log: DataFrame) -> DataFrame:
        rest = [c for c in self.schema.names if c not in self.keys]
        best = log.groupBy(*self.keys).agg(
            *[F.max_by(c, F.col(c)["place"]).alias(c) for c in rest], F.max(F.struct(RUN, BATCH)).alias("_at"))
        return best.select(*self.schema.names, f"_at.{RUN}", f"_at.{BATCH}")

    def _overlay(self, base: DataFrame, changes: DataFrame) -> DataFrame:
        """As for whole rows, but column by column."""
        rest = [c for c in self.schema.names if c not in self.keys]
        at = [RUN, BATCH]
        old = base.select(*self.keys, F.struct(*rest, *at).alias("_old"))
        new = changes.select(*self.keys, F.struct(*rest, *at).alias("_new"))
        both = old.join(new.hint("shuffle_hash"), self.keys, "full_outer")
        a, b = F.col("_old"), F.col("_new")
        return both.select(*self.keys, *[newer_column(a[c], b[c]).alias(c) for c in rest], *[F.coalesce(b[c], a[c]).alias(c) for c in at])


def _pair(position: tuple) -> Column:
    return F.struct(F.lit(position[0]).cast("int").alias(RUN), F.lit(position[1]).cast("long").alias(BATCH))


def _table_name(purpose: str, location: str) -> str:
    """Of the whole location: paths that differ in one character are different tables."""
    return f"unirec_{purpose}_" + hashlib.sha256(location.encode()).hexdigest()[:32]
