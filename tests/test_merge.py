"""Latest per key, upsert, the stored golden table, snapshot difference."""

import itertools

import pytest
from pyspark.sql import functions as F

from unirec.functions.shared import child_names, new_folder, path_exists
from unirec.operators.diff import snapshot_diff
from unirec.operators.latest import latest_per_key, latest_per_key_agg
from unirec.operators.upsert import split_null_keys, upsert
from unirec.sinks.golden import GoldenTable

COLUMNS = "id bigint, v string, _event_type string, _event_timestamp string, _partition int, _offset bigint"


def rows(spark, *data):
    """(id, value, event time[, event type[, offset]])"""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "INSERT", r[2], 0, r[4] if len(r) > 4 else 0) for r in data]
    return spark.createDataFrame(full, COLUMNS)


def content(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or ("id", "v"))).collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("pick", [latest_per_key, latest_per_key_agg])
def test_newest_row_by_instant_then_position(spark, pick):
    df = rows(
        spark,
        (1, "utc", "2024-01-01T10:00:00Z"), (1, "east", "2024-01-01T11:30:00+02:00"),
        (2, "low", "2024-01-01T10:00:00Z", "INSERT", 4), (2, "high", "2024-01-01T10:00:00Z", "INSERT", 9),
        (3, "none", None), (3, "some", "2023-01-01T00:00:00Z"),
        (4, "only", None),
    )
    assert content(pick(df, ["id"])) == [(1, "utc"), (2, "high"), (3, "some"), (4, "only")]


def test_hot_key_is_cut_before_the_shuffle(spark):
    plan = plan_of(latest_per_key(rows(spark, (1, "a", "2024-01-01T00:00:00Z")), ["id"]))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_whole_row_replaced_nulls_included(spark):
    target = rows(spark, (1, "old", "2024-01-02T00:00:00Z"), (2, "stay", "2024-01-01T00:00:00Z"))
    batch = rows(spark, (1, None, "2024-01-01T00:00:00Z"), (3, "new", "2024-01-01T00:00:00Z"))
    got = {r["id"]: r["v"] for r in upsert(target, batch, ["id"]).collect()}
    assert got == {1: None, 2: "stay", 3: "new"}
    guarded = {r["id"]: r["v"] for r in upsert(target, batch, ["id"], mode="event_time").collect()}
    assert guarded == {1: "old", 2: "stay", 3: "new"}


def test_null_keys_are_set_aside(spark):
    usable, nulls = split_null_keys(rows(spark, (None, "x", None), (1, "y", None)), ["id"])
    assert content(usable) == [(1, "y")]
    assert [r["v"] for r in nulls.collect()] == ["x"]
    assert upsert(None, rows(spark, (None, "x", None)), ["id"]).count() == 0


EVENTS = [
    (1, "a", "2024-01-01T00:00:00Z", "INSERT", 1), (1, "b", "2024-01-03T00:00:00Z", "UPDATE", 2),
    (2, "c", "2024-01-02T00:00:00Z", "INSERT", 3), (2, "c", "2024-01-04T00:00:00Z", "DELETE", 4),
    (1, "d", "2024-01-02T00:00:00Z", "UPDATE", 5),
]


@pytest.mark.parametrize("policy, want", [
    ("keep", [(1, "b"), (2, "c")]), ("tombstone", [(1, "b"), (2, "c")]), ("remove", [(1, "b")])])
def test_event_time_result_does_not_depend_on_order_or_split(spark, policy, want):
    store = "tombstone" if policy == "remove" else policy
    for order in list(itertools.permutations(EVENTS))[::35]:
        for cut in (0, 2, 4):
            merged = None
            for part in (order[:cut], order[cut:]):
                if part:
                    merged = upsert(merged, rows(spark, *part), ["id"], "event_time", delete_policy=store)
            last = upsert(merged, rows(spark), ["id"], "event_time", delete_policy=policy)
            assert content(last) == want
            if policy == "tombstone":
                assert content(last, "id", "_deleted") == [(1, False), (2, True)]


def golden(spark, df, **options):
    return GoldenTable(spark, new_folder(spark, "golden-test"), df.schema, ["id"], buckets=4, **options)


def test_golden_table_replay_compaction_and_late_events(spark):
    first, second = rows(spark, *EVENTS[:3]), rows(spark, *EVENTS[3:])
    late = rows(spark, (2, "late", "2024-01-03T00:00:00Z"), (3, "n", "2024-01-01T00:00:00Z"), (None, "q", None))
    table = golden(spark, first, mode="event_time", delete_policy="remove")
    assert table.read().count() == 0
    table.write_batch(first, 0)
    assert content(table.read()) == [(1, "b"), (2, "c")]
    table.write_batch(second, 1)
    table.write_batch(second, 1)
    assert content(table.read()) == [(1, "b")]
    table.compact()
    assert content(table.read()) == [(1, "b")]
    table.write_batch(late, 2)
    assert content(table.read()) == [(1, "b"), (3, "n")]
    table.compact()
    table.compact()
    assert content(table.read()) == [(1, "b"), (3, "n")]
    assert [r["v"] for r in table.quarantine().collect()] == ["q"]


def test_golden_table_arrival_order_wins(spark):
    table = golden(spark, rows(spark))
    table.write_batch(rows(spark, (1, "newer", "2024-02-01T00:00:00Z"), (2, "x", "2024-01-01T00:00:00Z")), 0)
    table.compact()
    table.write_batch(rows(spark, (1, "older", "2024-01-01T00:00:00Z")), 1)
    assert content(table.read()) == [(1, "older"), (2, "x")]
    table.write_batch(rows(spark, (2, "again", "2023-01-01T00:00:00Z")), 0, run=1)
    assert content(table.read()) == [(1, "older"), (2, "again")]


def test_golden_table_refuses_batches_of_a_lost_checkpoint(spark):
    table = golden(spark, rows(spark))
    for batch_id in (0, 1):
        table.write_batch(rows(spark, (1, "a", None)), batch_id)
    with pytest.raises(ValueError, match="raise `run`"):
        table.write_batch(rows(spark, (1, "b", None)), 0)


@pytest.mark.parametrize("mode", ["event_time", "arrival"])
@pytest.mark.parametrize("buckets", [8, 16])
def test_overlay_reads_the_base_without_a_shuffle(spark, mode, buckets):
    df = rows(spark, (1, "a", "2024-01-01T00:00:00Z"))
    table = GoldenTable(spark, new_folder(spark, "golden-test"), df.schema, ["id"], mode, buckets=buckets)
    table.write_batch(df, 0)
    table.compact()
    table.write_batch(rows(spark, (1, "b", "2024-01-02T00:00:00Z")), 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(table.read())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan
    assert content(table.read()) == [(1, "b")]


def test_base_keeps_the_bucket_count_it_was_written_with(spark):
    df = rows(spark, *[(i, str(i), "2024-01-01T00:00:00Z") for i in range(50)])
    path = new_folder(spark, "golden-test")
    written = GoldenTable(spark, path, df.schema, ["id"], buckets=16)
    written.write_batch(df, 0)
    written.compact()
    other = GoldenTable(spark, path, df.schema, ["id"], buckets=4)
    other.write_batch(rows(spark, (7, "new", "2024-01-01T00:00:00Z")), 1)
    other.compact()
    assert other.read().count() == 50
    assert content(other.read().filter("id = 7")) == [(7, "new")]


def test_diff_classifies_and_survives_repeated_keys(spark):
    schema = "id int, v string"
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z"), (4, "a"), (None, "n")], schema)
    new = spark.createDataFrame([(2, "b"), (3, "c"), (4, "z"), (4, "b"), (5, "e")], schema)
    got = snapshot_diff(old, new, ["id"]).select("event_type", "id", "v", F.col("before.v").alias("b"))
    assert sorted(map(tuple, got.collect())) == [
        ("DELETE", 1, "a", "a"), ("INSERT", 5, "e", None), ("UPDATE", 3, "c", None)]


def test_golden_paths_that_differ_in_one_sign_keep_their_rows(spark):
    """Bases are session tables; their names come from the whole path."""
    from unirec.functions.shared import new_folder
    from unirec.sinks.golden import GoldenTable

    root = new_folder(spark, "clash")
    schema = spark.createDataFrame([], "id long, v string, _event_type string, _event_timestamp string").schema
    tables = {}
    for name in ("order-item", "order_item", "Order_item"):
        table = GoldenTable(spark, f"{root}/{name}", schema, ["id"], buckets=2)
        table.write_batch(spark.createDataFrame([(1, name, "INSERT", "2024-01-01T00:00:00+00:00")], schema), 0)
        table.compact()
        tables[name] = table
    for name, table in tables.items():
        assert [r["v"] for r in table.read().collect()] == [name]


def test_golden_compaction_forgets_what_older_bases_folded(spark):
    from unirec.functions.shared import child_names, new_folder
    from unirec.sinks.golden import GoldenTable

    root = new_folder(spark, "retention")
    schema = spark.createDataFrame([], "id long, v string, _event_type string, _event_timestamp string").schema
    table = GoldenTable(spark, root, schema, ["id"], buckets=2)
    for batch in range(6):
        rows = [(k, f"b{batch}", "UPDATE", f"2024-01-0{batch + 1}T00:00:00+00:00") for k in range(batch + 1)]
        table.write_batch(spark.createDataFrame(rows, schema), batch)
        if batch % 2:
            table.compact()
    assert {r["id"]: r["v"] for r in table.read().collect()} == {k: "b5" for k in range(6)}
    batches = [n for n in child_names(spark, f"{root}/changes/_run=0") if n.startswith("_batch_id")]
    assert batches == ["_batch_id=4", "_batch_id=5"] and len(child_names(spark, f"{root}/base")) == 2
    assert len(child_names(spark, f"{root}/position")) <= 2 and table.last_batch() == (0, 5)


def test_remove_needs_the_tombstones_of_its_target(spark):
    import pytest

    from unirec.operators.upsert import upsert

    target = spark.createDataFrame([(1, "INSERT", "2024-01-01T00:00:00+00:00")], "id long, _event_type string, _event_timestamp string")
    with pytest.raises(ValueError):
        upsert(target, target, ["id"], mode="event_time", delete_policy="remove")


def above(plan, name):
    """For each leaf whose text holds ``name``: the nodes from the root down to it."""
    node = plan
    while node.nodeName() in ("AdaptiveSparkPlan", "ResultQueryStage"):
        node = node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node.plan()
    if node.children().isEmpty():
        return [[node.nodeName()]] if name in node.toString() else []
    return [[node.nodeName(), *path] for i in range(node.children().size()) for path in above(node.children().apply(i), name)]


def bucket_files(spark, table):
    root = f"{table.path}/base"
    return {(v, b): sorted(n for n in child_names(spark, f"{root}/{v}/{b}") if n.endswith(".parquet"))
            for v in child_names(spark, root) for b in child_names(spark, f"{root}/{v}") if b.startswith("_bucket=")}


@pytest.mark.parametrize("mode", ["event_time", "arrival"])
def test_golden_overlay_touches_changed_buckets_only(spark, mode):
    df = rows(spark, *[(i, f"v{i}", "2024-01-01T00:00:00Z") for i in range(200)])
    table = GoldenTable(spark, new_folder(spark, "golden-test"), df.schema, ["id"], mode, buckets=16)
    table.write_batch(df, 0)
    table.compact()
    assert all(len(files) == 1 for files in bucket_files(spark, table).values())
    before = bucket_files(spark, table)
    table.write_batch(rows(spark, (7, "new", "2024-01-02T00:00:00Z"), (1000, "added", "2024-01-02T00:00:00Z")), 1)
    hit = table.manifest().hit
    assert 1 <= len(hit) <= 2
    seen = table.read()
    paths = above(seen._jdf.queryExecution().executedPlan(), "unirec_base")
    assert len(paths) == 2 and all("Exchange" not in path and "Sort" not in path for path in paths), paths
    joined = [path for path in paths if "ShuffledHashJoin" in path]
    assert len(joined) == 1  # the other scan has no join above it
    want = {i: f"v{i}" for i in range(200)} | {7: "new", 1000: "added"}
    assert {r["id"]: r["v"] for r in seen.collect()} == want
    table.compact()
    after = bucket_files(spark, table)
    assert all(after[place] == files for place, files in before.items())
    assert sorted(set(after) - set(before)) == sorted((("v=2", f"_bucket={b}") for b in hit))
    assert {r["id"]: r["v"] for r in table.read().collect()} == want and table.manifest().hit == ()
    # What the second compaction replaced goes with the next one.
    table.write_batch(rows(spark, (8, "newer", "2024-01-03T00:00:00Z")), 2)
    table.compact()
    kept = bucket_files(spark, table)
    assert all(("v=1", f"_bucket={b}") not in kept for b in hit)
    assert {r["id"]: r["v"] for r in table.read().collect()} == want | {8: "newer"}


def test_golden_folds_bucket_by_bucket(spark):
    """Some buckets are folded, others wait; a late event and a replay count once."""
    df = rows(spark, *[(i, "a", "2024-01-01T00:00:00Z") for i in range(60)])
    table = GoldenTable(spark, new_folder(spark, "golden-test"), df.schema, ["id"], "event_time", "remove", buckets=8)
    table.write_batch(df, 0)
    assert sum(r["n_changes"] for r in table.changes_per_bucket().collect()) == 60
    table.compact([0, 1, 2])
    want = {i: "a" for i in range(60)}
    for batch in range(1, 6):
        ids = range(batch * 5, batch * 5 + 20)
        table.write_batch(rows(spark, *[(i, f"b{batch}", f"2024-01-0{1 + batch}T00:00:00Z") for i in ids], (3, "late", "2023-01-01T00:00:00Z")), batch)
        want |= {i: f"b{batch}" for i in ids}
        table.compact([batch, batch + 1])
        now = table.manifest()
        assert batch not in now.hit and now.fold(batch) == (0, batch)
        assert {r["id"]: r["v"] for r in table.read().collect()} == want
    again = GoldenTable(spark, table.path, df.schema, ["id"], "event_time", "remove", buckets=3)
    assert {r["id"]: r["v"] for r in again.read().collect()} == want
    again.rebucket(5)
    assert again.manifest().buckets == 5 and {r["id"]: r["v"] for r in table.read().collect()} == want
    again.write_batch(rows(spark, (59, "last", "2024-02-01T00:00:00Z")), 6)
    again.compact()
    assert {r["id"]: r["v"] for r in table.read().collect()} == want | {59: "last"}
    empty = GoldenTable(spark, new_folder(spark, "golden-test"), df.schema, ["id"], buckets=2)
    empty.compact()
    empty.rebucket(4)
    assert empty.read().count() == 0 and empty.changes_per_bucket().count() == 0


def test_reader_of_an_old_manifest_goes_on(spark):
    df = rows(spark, *[(i, "a", "2024-01-01T00:00:00Z") for i in range(20)])
    table = GoldenTable(spark, new_folder(spark, "golden-test"), df.schema, ["id"], buckets=4)
    table.write_batch(df, 0)
    table.compact()
    table.write_batch(rows(spark, (1, "b", "2024-01-02T00:00:00Z")), 1)
    old = table.manifest()
    reader = table.read_at(old)
    table.compact()
    assert {r["id"]: r["v"] for r in reader.collect()} == {r["id"]: r["v"] for r in table.read_at(old).collect()} == {i: "a" for i in range(20)} | {1: "b"}


def test_nulls_are_written_only_where_there_are_any(spark):
    df = rows(spark, (1, "a", "2024-01-01T00:00:00Z"))
    table = golden(spark, df)
    table.write_batch(df, 0)
    assert not path_exists(spark, f"{table.path}/quarantine") and table.quarantine().count() == 0
    table.write_batch(rows(spark, (None, "n", None)), 1)
    assert table.quarantine().count() == 1
    table.write_batch(rows(spark, (2, "n", None)), 1)
    assert content(table.read()) == [(1, "a"), (2, "n")]
