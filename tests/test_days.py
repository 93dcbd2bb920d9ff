"""Day folders with a record of batches: what counts, replays, folding, and sinks that move together."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from unirec.functions.shared import child_names, new_folder
from unirec.plans.derived import CUSTOMER, INGEST_DATE, entity_log
from unirec.sinks.commits import Commits
from unirec.sinks.days import DayTable
from unirec.sinks.raw import read_raw, write_raw_batch
from unirec.sources.topics import file_log_stream
from unirec.streaming.entity import EntityStream

ONE, TWO = dt.date(2024, 2, 1), dt.date(2024, 2, 2)
SCHEMA = "id long, _ingest_date date, source string"


def batch(spark, ids, day, source="a"):
    return spark.createDataFrame([(i, day, source) for i in ids], SCHEMA)


def day_table(spark, path=None):
    return DayTable(spark, path or new_folder(spark, "days"), spark.createDataFrame([], SCHEMA).schema, ("source",))


def ids(df):
    return sorted(r["id"] for r in df.collect())


def files(spark, table, day):
    return [f for f in table.read([day]).inputFiles()]


def test_a_day_is_listed_alone_and_batches_are_no_folders(spark):
    table = day_table(spark)
    assert table.read().count() == 0 and table.read([ONE]).columns == ["id", "_run", "_batch_id", "_ingest_date", "source"]
    for k in range(6):
        table.write_batch(batch(spark, [k], ONE if k < 4 else TWO, "ab"[k % 2]), k)
    assert sorted(n for n in child_names(spark, table.path) if n.startswith("_ingest")) == ["_ingest_date=2024-02-01", "_ingest_date=2024-02-02"]
    read = table.read([TWO])
    assert ids(read) == [4, 5] and len(read.inputFiles()) == 2 and all("_ingest_date=2024-02-02" in f for f in read.inputFiles())
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan and "2024-02-01" not in plan
    assert ids(table.read([ONE]).filter("source = 'b'")) == [1, 3]
    assert {(r["_run"], r["_batch_id"]) for r in table.read().collect()} == {(0, k) for k in range(6)}


def test_replays_replace_their_rows(spark):
    table = day_table(spark)
    table.write_batch(batch(spark, [1, 2], ONE), 0)
    table.write_batch(batch(spark, [3, 4], ONE), 1)
    table.write_batch(batch(spark, [3, 4, 5], TWO), 1)  # again, a day later
    assert ids(table.read()) == [1, 2, 3, 4, 5] and ids(table.read([ONE])) == [1, 2]
    assert ids(spark.read.parquet(f"{table.path}/_ingest_date=2024-02-01").select("id")) == [1, 2]  # the files are gone too
    with pytest.raises(ValueError, match="raise `run`"):
        table.write_batch(batch(spark, [9], ONE), 0)
    table.write_batch(batch(spark, [6], TWO), 0, run=1)
    assert ids(table.read()) == [1, 2, 3, 4, 5, 6]


def test_an_attempt_that_broke_off_never_counts(spark):
    table = day_table(spark)
    table.write_batch(batch(spark, [1], ONE), 0)
    table.commits.put({table.section: table.opened(1, days=[TWO])})
    table.prepare_batch(batch(spark, [2, 3], TWO), 1)  # the record does not move
    assert ids(table.read()) == [1]
    again = day_table(spark, table.path)
    again.write_batch(batch(spark, [2], TWO), 1)
    assert ids(again.read()) == ids(spark.read.parquet(table.path).select("id")) == [1, 2]
    with pytest.raises(ValueError, match="announced"):
        again.prepare_batch(batch(spark, [2], TWO), 2)
    with pytest.raises(ValueError):
        again.fold_day(ONE) or again.commits.put({again.section: again.opened(3)}) or again.fold_day(ONE)


def test_finished_days_are_folded(spark):
    table = day_table(spark)
    for k in range(5):
        table.write_batch(batch(spark, [10 * k, 10 * k + 1], ONE, "ab"[k % 2]), k)
    with pytest.raises(ValueError, match="not finished"):
        table.fold_day(ONE)
    table.write_batch(batch(spark, [100], TWO), 5)
    want, reader = ids(table.read()), table.read()
    assert len(files(spark, table, ONE)) >= 5
    table.fold_day(ONE)
    assert len(files(spark, table, ONE)) == 2 and ids(table.read()) == ids(reader) == want
    assert {(r["_batch_id"], r["id"]) for r in table.read([ONE]).collect()} == {(k, 10 * k + i) for k in range(5) for i in (0, 1)}
    table.write_batch(batch(spark, [7], ONE), 6)  # late, into a folded day
    table.write_batch(batch(spark, [7, 8], ONE), 6)
    table.write_batch(batch(spark, [200], TWO), 7)
    table.fold_day(ONE)
    assert ids(table.read()) == sorted(want + [7, 8, 200]) and len(child_names(spark, f"{table.path}/_ingest_date=2024-02-01")) == 2
    table.fold_day(dt.date(2030, 1, 1))


def test_rows_without_a_date(spark):
    table = day_table(spark)
    table.write_batch(batch(spark, [1], None).unionByName(batch(spark, [2], ONE)), 0)
    table.write_batch(batch(spark, [3], TWO), 1)
    table.fold_day(None)
    assert ids(table.read([None])) == [1] and ids(table.read()) == [1, 2, 3]


def test_raw_functions_keep_their_columns(spark):
    path = new_folder(spark, "raw")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, source string")
    write_raw_batch(rows, path, 0, ingest_date=F.to_date(F.lit("2024-02-01")))
    write_raw_batch(rows, path, 1)
    assert ids(read_raw(spark, path, rows.schema)) == [1, 1, 2, 2]
    assert ids(read_raw(spark, path, rows.schema, [ONE]).filter("source = 'a'")) == [1]


def test_sections_move_together(spark):
    commits = Commits(spark, new_folder(spark, "commits"))
    assert commits.get("a") is None
    commits.put({"a": {"x": 1}, "b": {"x": 1}})
    commits.put({"b": {"x": 2}})
    assert commits.all() == {"a": {"x": 1}, "b": {"x": 2}}


def test_three_sinks_show_a_batch_together_or_not_at_all(spark, sf_dir):
    log, root = new_folder(spark, "atomic-log"), new_folder(spark, "atomic")
    events = entity_log(spark, sf_dir, "customer")
    parts = [events.filter(F.pmod("offset", F.lit(2)) == k) for k in (0, 1)]
    counts = [p.count() for p in parts]
    parts[0].coalesce(1).write.mode("append").partitionBy("topic").parquet(log)

    def stream():
        return EntityStream(spark, CUSTOMER, root, mode="event_time", ingest_date=INGEST_DATE)

    def go(s):
        s.start(file_log_stream(spark, log, ["customer"]), trigger={"availableNow": True}).awaitTermination()

    def seen():
        s = stream()  # a reader of its own
        return s.read_raw().count(), s.read_canonical().count(), s.read_warehouse().count()

    go(stream())
    before = seen()
    assert before[0] == before[2] == counts[0]
    parts[1].coalesce(1).write.mode("append").partitionBy("topic").parquet(log)
    for sink in ("canonical", "warehouse"):
        failing = stream()
        setattr(failing, f"write_{sink}", lambda batch, batch_id, day: 1 / 0)
        with pytest.raises(Exception, match="division"):
            go(failing)
        assert seen() == before  # the sinks before it have written their files
    go(stream())
    after = seen()
    assert after[0] == after[2] == sum(counts) and after[1] == 150
    assert stream().read_counts().filter("sink = 'raw'").agg(F.sum("n_rows")).first()[0] == sum(counts)
    assert stream().read_dead_letters().count() == 0
