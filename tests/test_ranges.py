"""Key ranges: chunked backfill that can break off, and snapshots compared by the digests of their ranges."""

import json

import pytest
from pyspark.sql import functions as F

from unirec.functions.shared import new_folder, read_state
from unirec.operators.diff import snapshot_diff
from unirec.operators.ranges import SnapshotStore, in_range, key_bounds, range_number
from unirec.sources.envelope import decode_events, encode_events
from unirec.sources.topics import file_log, publish_to_file_log
from unirec.streaming.backfill import backfill_chunks


@pytest.mark.parametrize("kind", ["long", "string", "date"])
def test_ranges_cover_every_key_once(spark, kind):
    df = spark.range(500).select(
        (F.col("id") if kind == "long" else F.concat(F.lit("k"), F.col("id")) if kind == "string" else F.date_add(F.lit("2020-01-01"), F.col("id").cast("int"))).alias("k"))
    df = df.unionByName(df.limit(1).withColumn("k", F.lit(None).cast(df.schema["k"].dataType)))
    dtype, bounds = df.schema["k"].dataType, key_bounds(df, "k", 8)
    assert len(bounds) == 7
    marked = df.withColumn("n", range_number(F.col("k"), dtype, bounds))
    for number in range(8):
        mine = {r["k"] for r in df.filter(in_range(F.col("k"), dtype, bounds, number)).collect()}
        assert mine == {r["k"] for r in marked.filter(F.col("n") == number).collect()} and len(mine) > 20
    assert marked.count() == 501 and key_bounds(df.limit(0), "k", 8) == []


def test_backfill_goes_on_at_its_chunk(spark):
    root = new_folder(spark, "chunks")
    rows = spark.range(100).select("id", F.lit("old").alias("v")).unionByName(spark.createDataFrame([(None, "null")], "id long, v string"))
    asked = []

    def read():
        asked.append(1)
        return rows

    calls = []

    def fail_at_two(number):
        calls.append(number)
        if number == 2:
            raise RuntimeError("stop")

    with pytest.raises(RuntimeError):
        backfill_chunks(read, "s", "e", "id", f"{root}/log", f"{root}/state", 4, fail_at_two)
    assert json.loads(read_state(spark, f"{root}/state"))["next"] == 2
    assert backfill_chunks(read, "s", "e", "id", f"{root}/log", f"{root}/state", 4, calls.append, most=1) == 1
    assert backfill_chunks(read, "s", "e", "id", f"{root}/log", f"{root}/state", 4, calls.append) == 0
    assert backfill_chunks(read, "s", "e", "id", f"{root}/log", f"{root}/state", 4, calls.append) == 0
    assert calls == [0, 1, 2, 2, 3]
    events = decode_events(file_log(spark, f"{root}/log"))
    assert events.count() == events.select("event_id").distinct().count() == 101


def test_changes_between_the_marks_win(spark):
    root = new_folder(spark, "chunks")
    log = f"{root}/log"
    rows = spark.range(40).select("id", F.lit("old").alias("v"))

    def poll(number):
        if number == 0:
            for source, ids in (("s", [0, 1, 39]), ("other", [2])):  # another source's key 2 is another key
                changed = spark.createDataFrame([(i, "new") for i in ids], "id long, v string")
                publish_to_file_log(encode_events(changed, source, "e", "UPDATE"), log)

    backfill_chunks(lambda: rows, "s", "e", "id", log, f"{root}/state", 2, poll)
    events = decode_events(file_log(spark, log)).filter("source = 's'").select(
        F.get_json_object("payload", "$.id").cast("long").alias("id"), F.get_json_object("payload", "$.v").alias("v"), "kafka_offset")
    snapshots = {r["id"] for r in events.filter("v = 'old'").collect()}
    assert snapshots == set(range(2, 40))  # 39 changed before its own chunk was read


def test_unchanged_ranges_are_not_read(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("v"), F.lit(None).cast("string").alias("n"))
    later = df.filter("id <> 15").withColumn("v", F.when(F.col("id") == 17, 99).otherwise(F.col("v"))).unionByName(
        spark.createDataFrame([(5000, 1, "x"), (5000, 1, "x")], "id long, v long, n string"))
    store = SnapshotStore(spark, new_folder(spark, "store"), df.schema, ["id"], ranges=10)
    store.write(df, "1")
    store.write(later, "2")
    store.write(later, "2")
    assert store.changed_ranges("1", "2") == [0, 9] and store.changed_ranges("2", "2") == []
    found = store.diff("1", "2")
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = [line.split("PartitionFilters: ")[1] for line in plan.splitlines() if "PartitionFilters: " in line]
    assert len(filters) == 2 and all(f.startswith("[_range") and "IN (0,9)" in f.split("]")[0] for f in filters), filters
    want = snapshot_diff(df, later, ["id"])
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect())) and found.count() == 3
    assert store.diff("2", "2").count() == 0 and store.read("1").count() == 1000
    with pytest.raises(ValueError):
        store.read("3")


def test_repeated_rows_and_nulls_have_digests(spark):
    """Rows that come twice, and nulls against empty values, are seen."""
    schema = "id long, v string"
    base = [(1, None), (2, "a"), (2, "a")]
    store = SnapshotStore(spark, new_folder(spark, "store"), spark.createDataFrame([], schema).schema, ["id"], ranges=1)
    for number, rows in enumerate([base, [(1, ""), (2, "a"), (2, "a")], [(1, None), (2, "a")], [(1, None)] + [(2, "a")] * 4, base[::-1], []]):
        store.write(spark.createDataFrame(rows, schema), str(number))
    assert [store.changed_ranges("0", str(k)) for k in range(1, 6)] == [[0], [0], [0], [], [0]]
