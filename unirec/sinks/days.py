"""Append table in day folders, with a record of the batches that count.

    <path>/_ingest_date=D/_gen=G/[source=S/]    files of many batches
    <path>/_position/ (or a record shared with other sinks)

The batch is a column of the data and not a folder, so reading a day lists that day alone, however many batches there are.
Rows carry their run, batch and attempt; a reader takes the rows up to the last batch of the record, and of that batch those
of the attempt that counts.  Files hold one batch each, so their statistics skip what does not count.  A repeated batch is a
new attempt; the rows of the attempt before it, or of one that broke off, are removed with their files.

``fold_day`` writes the files of a finished day anew as few large ones, in the day's next generation.  Readers of the
generation before go on until the next fold.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unirec.functions.shared import child_names, remove
from unirec.sinks.commits import Commits

RUN, BATCH, ATTEMPT, DAY, GENERATION = "_run", "_batch_id", "_attempt", "_ingest_date", "_gen"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
EMPTY = {"batch": None, "attempt": 0, "days": None, "open": None, "stale": None, "generations": {}, "old": []}


class DayTable:
    """``schema``: the columns of the rows, without run and batch.  ``within`` are columns to make folders of inside a day."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, within: Sequence[str] = (), commits: Commits | None = None,
        section: str = "rows",
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.within = list(within)
        self.commits = commits or Commits(spark, f"{self.path}/_position")
        self.section = section
        folders = (DAY, *self.within)
        plain = [f for f in schema.fields if f.name not in (*folders, RUN, BATCH)]
        inside = [next((f for f in schema.fields if f.name == c), T.StructField(c, T.StringType())) for c in self.within]
        mark = [T.StructField(RUN, T.IntegerType()), T.StructField(BATCH, T.LongType())]
        self.schema = T.StructType([*plain, *mark, T.StructField(DAY, T.DateType()), *inside])
        self.stored = T.StructType([*plain, *mark, T.StructField(ATTEMPT, T.IntegerType()), T.StructField(DAY, T.DateType()),
                                    T.StructField(GENERATION, T.IntegerType()), *inside])

    def state(self) -> dict:
        return EMPTY | (self.commits.get(self.section) or {})

    # --- writing ---

    def write_batch(self, batch: DataFrame, batch_id: int, run: int = 0, days: Sequence[date] | None = None) -> None:
        """Add one batch with its ``_ingest_date``; ``days`` names the dates where they are known."""
        self.commits.put({self.section: self.opened(batch_id, run, days)})
        self.commits.put({self.section: self.prepare_batch(batch, batch_id, run)})
        self.clear()

    def opened(self, batch_id: int, run: int = 0, days: Sequence[date] | None = None) -> dict:
        """The section that announces a batch, to be put before its rows are written."""
        now = self.state()
        if now["batch"] is not None and [run, batch_id] < now["batch"]:
            raise ValueError(f"batch {batch_id} of run {run} is older than {tuple(now['batch'])}: raise `run` after a fresh checkpoint")
        self.clear()
        attempt = 0
        for earlier, number in ((now["batch"], now["attempt"]), (now["open"] and now["open"]["batch"], now["open"] and now["open"]["attempt"])):
            if earlier == [run, batch_id]:
                attempt = max(attempt, number + 1)
        return now | {"open": {"batch": [run, batch_id], "attempt": attempt, "days": None if days is None else [str(d) for d in days]}, "stale": None}

    def prepare_batch(self, batch: DataFrame, batch_id: int, run: int = 0) -> dict:
        """Write the rows of an announced batch and return the section that makes it count."""
        now = self.state()
        begun = now["open"]
        if not begun or begun["batch"] != [run, batch_id]:
            raise ValueError(f"batch {batch_id} of run {run} was not announced")
        rows = batch.withColumns({RUN: F.lit(run), BATCH: F.lit(batch_id).cast("long"), ATTEMPT: F.lit(begun["attempt"]), GENERATION: self._generation(now)})
        (rows.select(*self.stored.names).write.mode("append").option("compression", "snappy")
         .partitionBy(DAY, GENERATION, *self.within).parquet(self.path))
        stale = None
        if now["batch"] == [run, batch_id]:
            stale = {"batch": now["batch"], "attempt": now["attempt"], "days": now["days"]}
        return now | {"batch": begun["batch"], "attempt": begun["attempt"], "days": begun["days"], "open": None, "stale": stale}

    def clear(self) -> None:
        """Remove the files of an attempt that was repeated or broke off."""
        now = self.state()
        for gone in (now["stale"], now["open"]):
            if gone:
                for file in self._files_of(now, gone):
                    remove(self.spark, file)

    def _files_of(self, now: dict, gone: dict) -> list[str]:
        days = None if gone["days"] is None else [date.fromisoformat(d) for d in gone["days"]]
        rows = self._stored_rows(now, days)
        if rows is None:
            return []
        mine = (F.col(RUN) == gone["batch"][0]) & (F.col(BATCH) == gone["batch"][1]) & (F.col(ATTEMPT) == gone["attempt"])
        return [r[0] for r in rows.filter(mine).select("_metadata.file_path").distinct().collect()]

    def _generation(self, now: dict) -> Column:
        """The generation of a row's day."""
        folded = [x for day, g in now["generations"].items() for x in (F.lit(day), F.lit(g))]
        if not folded:
            return F.lit(0)
        return F.coalesce(F.create_map(*folded)[F.coalesce(F.col(DAY).cast("string"), F.lit(NO_DAY))], F.lit(0))

    # --- reading ---

    def days(self) -> list[str]:
        """Names of the days that have a folder."""
        return [n.split("=", 1)[1] for n in child_names(self.spark, self.path) if n.startswith(f"{DAY}=")]

    def _stored_rows(self, now: dict, days: Sequence[date] | None) -> DataFrame | None:
        """Rows of all batches and attempts in the current generations of the days."""
        names = self.days()
        if days is not None:
            wanted = {str(d) if d is not None else NO_DAY for d in days}
            names = [n for n in names if n in wanted]
        paths = [f"{self.path}/{DAY}={n}/{GENERATION}={now['generations'].get(n, 0)}" for n in names]
        if not paths:
            return None
        return self.spark.read.schema(self.stored).option("basePath", self.path).parquet(*paths)

    def read(self, days: Sequence[date] | None = None) -> DataFrame:
        """The rows that count, of the named days or of all; only the folders of those days are listed."""
        return self._counting(self.state(), days)

    def _counting(self, now: dict, days: Sequence[date] | None) -> DataFrame:
        rows = self._stored_rows(now, days) if now["batch"] is not None else None
        if rows is None:
            return self.spark.createDataFrame([], self.schema)
        run, batch = now["batch"]
        at_last = (F.col(RUN) == run) & (F.col(BATCH) == batch)
        earlier = (F.col(RUN) < run) | ((F.col(RUN) == run) & (F.col(BATCH) < batch))
        return rows.filter(earlier | (at_last & (F.col(ATTEMPT) == now["attempt"]))).select(*self.schema.names)

    # --- folding ---

    def fold_day(self, day: date | None, files: int = 1) -> None:
        """Write the rows of a finished day as ``files`` files (for each folder inside the day), sorted by batch."""
        now, name = self.state(), str(day) if day is not None else NO_DAY
        if now["batch"] is None or name not in self.days():
            return
        if now["open"]:
            raise ValueError("a batch is being written")
        rows = self._counting(now, [day])
        run, batch = now["batch"]
        if not rows.filter((F.col(RUN) == run) & (F.col(BATCH) == batch)).isEmpty():
            raise ValueError(f"the last batch has rows of {name}: the day is not finished")
        for old_name, old in now["old"]:
            remove(self.spark, f"{self.path}/{DAY}={old_name}/{GENERATION}={old}")
        before = now["generations"].get(name, 0)
        target = f"{self.path}/{DAY}={name}/{GENERATION}={before + 1}"
        slot = F.pmod(F.xxhash64(RUN, BATCH, F.monotonically_increasing_id()), F.lit(files))
        dealt = rows.withColumns({ATTEMPT: F.lit(0), "_slot": slot}).repartition(max(files, 1), *self.within, "_slot")
        writer = dealt.sortWithinPartitions(*self.within, RUN, BATCH).drop("_slot", DAY).write.mode("overwrite")
        (writer.partitionBy(*self.within) if self.within else writer).parquet(target)
        self.commits.put({self.section: now | {"generations": now["generations"] | {name: before + 1}, "old": [[name, before]]}})
