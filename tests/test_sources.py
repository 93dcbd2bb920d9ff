"""Envelope, scans, catalogues, discovery, watermarks, sinks."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from unirec.functions.names import entity_name, skeleton, snake
from unirec.functions.shared import child_names, new_folder, remove, write_state
from unirec.operators.match import match_entities, propose_mappings
from unirec.operators.profile import infer_json_columns, infer_json_paths, merge_key_candidates
from unirec.sinks.warehouse import coerce_datetimes, create_namespace, create_or_append, datetime_columns
from unirec.sources.catalog import column_statistics, dictionary_catalog, information_schema_catalog, normalise_columns, with_statistics
from unirec.sources.envelope import (
    LOG_SCHEMA, dead_letters, decode_events, encode_events, event_key, live_events, serialise, valid_event_type,
)
from unirec.sources.scan import incremental_scan, jdbc_options, unwrap_records
from unirec.sources.topics import file_log, kafka_options, publish_to_file_log
from unirec.sources.watermarks import advance_watermark, current_watermark, watermarks
from unirec.streaming.backfill import publish_increment


def log_of(spark, values):
    data = [(None, None if v is None else v.encode(), "t", 0, i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(data, LOG_SCHEMA)


def test_encode_and_decode(spark):
    df = spark.createDataFrame(
        [(1, decimal.Decimal("1.50"), dt.datetime(2024, 1, 2, 3, 4, 5), None, (7, [1.5]))],
        "id int, amount decimal(9,2), at timestamp, gone string, inner struct<k:int,xs:array<double>>")
    events = encode_events(df, "postgres", "thing", event_time=F.col("at"), database="db")
    row = serialise(events).first()
    assert bytes(row["key"]) == b"1" and row["topic"] == "canonical.thing"
    text = bytes(row["value"]).decode()
    assert '"amount":"1.50"' in text and '"at":"2024-01-02T03:04:05.000000+00:00"' in text
    assert '"gone":null' in text and '"before":null' in text and '"inner":{"k":7,"xs":[1.5]}' in text
    got = decode_events(log_of(spark, [text])).first()
    assert (got["event_timestamp"], got["source_table"], got["source_database"]) == (
        "2024-01-02T03:04:05.000000+00:00", "thing", "db")


def test_event_ids_repeat_only_for_equal_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "id int, v string")
    ids = [r["event_id"] for kind in ("SNAPSHOT", "INSERT") for r in encode_events(df, "s", "t", kind).collect()]
    assert len(set(ids)) == 2
    assert encode_events(df, "s", "t", "DELETE").first()["event_id"] not in ids


def test_dead_letters(spark):
    good = '{"event_id":"1","event_type":"OTHER","payload":{"a":1}}'
    decoded = decode_events(log_of(spark, [None, "not json", "{}", "[1]", good]), keep_raw=True)
    assert sorted((r["kafka_offset"], r["reason"]) for r in dead_letters(decoded).collect()) == [
        (0, "empty"), (1, "malformed"), (2, "malformed"), (3, "malformed")]
    live = live_events(decoded)
    assert [r["payload"] for r in live.collect()] == ['{"a":1}']
    assert live.filter(valid_event_type()).count() == 0


def test_value_is_parsed_once_below_filters(spark):
    decoded = live_events(decode_events(log_of(spark, ["{}"]))).filter("source = 'postgres'")
    assert decoded._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


@pytest.mark.parametrize("columns, want", [
    ("thing_id int, id int", "1"), ("id int, ID2 int", "1"), ("other int, x int", None)])
def test_event_key(spark, columns, want):
    df = spark.createDataFrame([(1, 2)], columns)
    assert df.select(event_key(df, "thing").alias("k")).first()["k"] == want


def test_unwrap_records(spark):
    docs = [
        '[{"a":1},{"a":2}]', '{"rows":[{"a":3}],"value":[{"a":0}]}', '{"value":[]}', '{"other":[1]}', "bad", None,
        '[{"text":"{\\"a\\":4}"},{"text":"nope"},{"text":null}]', '{"result":null,"data":[{"a":0}]}', "[]",
    ]
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    assert sorted(r["record"] for r in unwrap_records(df, "doc").collect()) == [
        '{"a":1}', '{"a":2}', '{"a":3}', '{"a":4}']


def test_increment_is_strictly_above_and_pushed_down(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    mark = orders.agg(F.max("o_orderdate")).first()[0]
    assert incremental_scan(orders, "o_orderdate", mark).count() == 0
    assert incremental_scan(orders, "o_orderdate", None).count() == orders.count()
    plan = incremental_scan(orders, "o_orderdate", mark)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate" in plan


def test_reader_options():
    assert jdbc_options("jdbc:x", "t")["dbtable"] == "t"
    bounds = jdbc_options("jdbc:x", "t", "id", 0, 100, 8, user="u")
    assert (bounds["numPartitions"], bounds["upperBound"], bounds["user"]) == ("8", "100", "u")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "id")
    options = kafka_options("h:1", ["a", "b"], max_offsets_per_trigger=10, min_partitions=64)
    assert options["subscribe"] == "canonical.a,canonical.b" and options["failOnDataLoss"] == "false"
    assert (options["maxOffsetsPerTrigger"], options["minPartitions"]) == ("10", "64")


def test_file_log_offsets_grow(spark):
    path = new_folder(spark, "log-test")
    events = encode_events(spark.range(20).repartition(4), "s", "thing")
    for _ in range(2):
        publish_to_file_log(events, path)
    log = file_log(spark, path, ["thing"])
    assert log.count() == 40 and log.select("offset").distinct().count() == 40
    assert log.select("partition").distinct().count() == 3


def test_watermark_is_the_highest_written(spark):
    path = new_folder(spark, "marks-test")
    assert current_watermark(spark, path, "s", "e") is None
    for day in (2, 1):
        advance_watermark(spark, path, "s", "e", dt.datetime(2024, 1, day))
    assert current_watermark(spark, path, "s", "e") == dt.datetime(2024, 1, 2)


def test_catalogues(spark):
    tables = spark.createDataFrame(
        [("public", "b", "BASE TABLE"), ("public", "a", "BASE TABLE"), ("public", "v", "VIEW"), ("x", "c", "BASE TABLE"),
         ("public", "", "BASE TABLE")], "table_schema string, table_name string, table_type string")
    columns = spark.createDataFrame(
        [("public", "b", 1, "id", "int", "NO"), ("public", "a", 2, "n", "text", "YES"), ("public", "a", 1, "k", "int", "NO"),
         ("public", "v", 1, "z", "int", "YES")],
        "table_schema string, table_name string, ordinal_position int, column_name string, data_type string, is_nullable string")
    got = information_schema_catalog(tables, columns, "public", "db").select("table", "name", "nullable").collect()
    assert [tuple(r) for r in got] == [("a", "k", False), ("a", "n", True), ("b", "id", False)]
    tables = spark.createDataFrame([("DB ", "T1 ", "T"), ("DB", "V1", "V")], "DatabaseName string, TableName string, TableKind string")
    columns = spark.createDataFrame(
        [("DB", "T1", "C2 ", "CV ", "Y", 2), ("DB", "T1", "C1", "I", "N", 1), ("DB", "V1", "C", "I", "N", 1)],
        "DatabaseName string, TableName string, ColumnName string, ColumnType string, Nullable string, ColumnId int")
    got = dictionary_catalog(tables, columns, "DB").select("table", "name", "data_type", "nullable").collect()
    assert [tuple(r) for r in got] == [("T1", "C1", "I", False), ("T1", "C2", "CV", True)]
    given = normalise_columns(spark.createDataFrame([("x", None)], "COLUMN_NAME string, Nullable int")).first()
    assert tuple(given) == ("x", "unknown", True, False)


def test_json_types_over_all_rows(spark):
    docs = ['{"id":1,"f":1,"d":"2024-01-01","b":true,"m":1,"n":null,"o":{"x":1}}',
            '{"id":2,"f":1.5,"d":"2024-01-02","b":null,"m":"x","n":null}', "bad", None]
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    got = {r["name"]: (r["data_type"], r["n_nulls"], r["is_primary_key"], r["row_count"])
           for r in infer_json_columns(df, "doc").collect()}
    assert got == {
        "id": ("integer", 0, True, 4), "f": ("float", 0, False, 4), "d": ("date", 0, False, 4),
        "b": ("boolean", 1, False, 4), "m": ("string", 0, False, 4), "n": ("string", 2, False, 4),
        "o": ("string", 0, False, 4)}


def test_merge_key_candidates(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, None, 2)], "k int, n string, g int")
    got = {r["candidate"]: (r["n_rows"], r["n_distinct"], r["n_null"], r["is_key"])
           for r in merge_key_candidates(df, [["k"], ["n"], ["g", "k"]]).collect()}
    assert got == {"k": (3, 3, 0, True), "n": (3, 1, 1, False), "g+k": (3, 3, 0, True)}


def test_names(spark):
    names = ["dbo.Customers", "ORDER_ITEMS", "Categories", "status", "addressBook", "boxes", "class"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(entity_name(F.col("n"))).collect()
    assert [r[0] for r in got] == ["customer", "order_item", "category", "status", "address_book", "box", "class"]
    row = spark.createDataFrame([("NationId", "nation_name")], "a string, b string").select(
        snake(F.col("a")), skeleton(F.col("b"))).first()
    assert tuple(row) == ("nation_id", "ntn_nm")


def test_match_prefers_the_table_that_shares_columns(spark):
    rows = [("postgres", "customer", c) for c in ("id", "name")] + [("postgres", "customers", c) for c in ("id", "x", "y")]
    rows += [("sqlserver", "Customers", c) for c in ("Id", "Name")] + [("teradata", "PARTS", "P")]
    catalog = spark.createDataFrame(rows, "source string, table string, name string")
    got = {r["canonical_name"]: tuple(r)[1:] for r in match_entities(catalog).collect()}
    assert got == {"customer": ("customer", "Customers", None), "part": (None, None, "PARTS")}


def test_mapping_proposals(spark):
    columns = spark.createDataFrame(
        [("customer", "td", "C", n) for n in ("CUST_ID", "CUST_NM", "Segment", "zzz", "CustomerBalance")] + [("customer", "pg", "c", "id")],
        "canonical_name string, source string, table string, name string")
    fields = spark.createDataFrame(
        [("customer", f) for f in ("customer_id", "name", "segment", "customer_balance")], "canonical_name string, canonical_field string")
    got = {r["source_field"]: (r["canonical_field"], r["rule"]) for r in propose_mappings(columns, fields).collect()}
    assert got == {"CUST_ID": ("customer_id", 3), "CUST_NM": ("name", 5), "Segment": ("segment", 1), "id": ("customer_id", 2),
                   "CustomerBalance": ("customer_balance", 1)}


def test_names_without_a_signature_are_matched_one_to_one(spark):
    columns = spark.createDataFrame(
        [("customer", "s", "t", n, k) for n, k in (
            ("segment", "string"), ("telefoon", "string"), ("telefone", "string"), ("zip_kode", "integer"), ("created_ts", "string"), ("xx", "string"))],
        "canonical_name string, source string, table string, name string, data_type string")
    fields = spark.createDataFrame(
        [("customer", n, k) for n, k in (
            ("segment", "string"), ("telephone", "string"), ("zip_code", "boolean"), ("updated_at", "timestamp"), ("zip_area", "integer"), ("queue", "string"))],
        "canonical_name string, canonical_field string, data_type string")
    got = {r["source_field"]: (r["canonical_field"], r["rule"]) for r in propose_mappings(columns, fields).collect()}
    # zip_kode is nearer to zip_code, whose type is of another family; the less similar telefoon finds its field taken.
    assert got == {"segment": ("segment", 1), "telefone": ("telephone", 6), "created_ts": ("updated_at", 6), "zip_kode": ("zip_area", 6)}


def test_datetime_columns_as_a_whole(spark):
    df = spark.createDataFrame([("2024-01-01", "2024-01-01", None, 1), (None, "x", None, 2)], "a string, b string, c string, d int")
    assert datetime_columns(df) == ["a"]
    assert dict(coerce_datetimes(df, ["a"]).dtypes)["a"] == "timestamp"


def test_catalogue_tables_are_created_then_appended(spark):
    create_namespace(spark, "landing")
    for _ in range(2):
        create_or_append(spark.range(3).withColumn("p", F.lit("x")), "landing.things", ["p"])
    assert spark.table("landing.things").count() == 6


def test_session_time_zone_does_not_reach_the_bytes(spark):
    """Instants around a change of clocks: the same bytes and ids in every zone; local times stay as they are."""
    rows = [(1, 1699163999), (2, 1699164000), (3, 1699167600), (4, 1710054000), (5, -1)]
    written = []
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            df = spark.createDataFrame(rows, "id int, s long").select(
                "id", F.timestamp_seconds("s").alias("at"), F.lit("2024-03-10 02:30:00").cast("timestamp_ntz").alias("local"))
            events = encode_events(df, "postgres", "thing", event_time=F.col("at"))
            written.append(sorted(bytes(r["value"]) for r in serialise(events).collect()))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert written[0] == written[1] == written[2]
    whole = b"".join(written[0])
    assert b"2023-11-05T06:00:00.000000+00:00" in whole and b"1969-12-31T23:59:59.000000+00:00" in whole and b"2024-03-10 02:30:00" in whole


def test_catalogue_words_and_names_per_row(spark):
    rows = spark.createDataFrame([(None, "a", "PRI"), ("b", "x", ""), ("c", None, "true")], "name string, column_name string, is_primary_key string")
    assert [(r["name"], r["is_primary_key"]) for r in normalise_columns(rows).collect()] == [("a", False), ("b", False), ("c", True)]


def test_first_block_without_text(spark):
    docs = spark.createDataFrame([('[{"text":null},{"text":"{\\"id\\":1}"}]',)], "d string")
    assert [r["record"] for r in unwrap_records(docs, "d").collect()] == ['{"id":1}']


def test_wide_integers_are_integers(spark):
    docs = spark.createDataFrame([('{"v":99999999999999999999}',), ('{"v":1}',)], "doc string")
    row = infer_json_columns(docs, "doc").first()
    assert (row["data_type"], row["row_count"]) == ("integer", 2)


def test_column_statistics_count_values(spark):
    table = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "id long, `a.b` string")
    none = table.limit(0)
    got = {(r.table, r.name): (r.row_count, r.value_count) for r in column_statistics({"t": table, "empty": none}).collect()}
    assert got == {("t", "id"): (3, 3), ("t", "a.b"): (3, 1), ("empty", "id"): (0, 0), ("empty", "a.b"): (0, 0)}
    columns = spark.createDataFrame([("public", "t", 1, "id", "bigint", "NO"), ("public", "t", 2, "other", "text", "YES")],
                                    "table_schema string, table_name string, ordinal_position int, column_name string, data_type string, is_nullable string")
    tables = spark.createDataFrame([("public", "t", "BASE TABLE")], "table_schema string, table_name string, table_type string")
    found = with_statistics(information_schema_catalog(tables, columns, "public", "db"), column_statistics({"t": table}))
    assert [(r.name, r.row_count, r.value_count) for r in found.orderBy("ordinal").collect()] == [("id", 3, 3), ("other", None, None)]


def test_state_of_polls_stays_small(spark):
    """Each poll replaces one record; no poll reads what earlier ones wrote."""
    root = new_folder(spark, "polls")
    log, marks = f"{root}/log", f"{root}/marks"
    start = dt.datetime(2024, 1, 1)
    files = set()
    for k in range(12):
        df = spark.createDataFrame([(i, start + dt.timedelta(hours=i)) for i in range(k + 1)], "id long, t timestamp")
        for source in ("a/b", "ünï"):
            assert publish_increment(df, source, "thing", "t", log, marks, key=F.col("id")) == 1
        files.add(len(child_names(spark, f"{marks}/s-a%2Fb/e-thing")))
        files.add(len(child_names(spark, f"{log}/_next_offset")))
    assert max(files) <= 2
    rows = file_log(spark, log).agg(F.count("*").alias("n"), F.countDistinct("offset").alias("d"), F.max("offset").alias("m")).first()
    assert rows["n"] == rows["d"] == 24
    assert {(r.source, r.watermark) for r in watermarks(spark, marks).collect()} == {(s, start + dt.timedelta(hours=11)) for s in ("a/b", "ünï")}
    # Without its data files the log still knows the next offset, so it is not scanned.
    remove(spark, f"{log}/topic=canonical.thing")
    publish_increment(spark.createDataFrame([(99, start + dt.timedelta(days=9))], "id long, t timestamp"), "a/b", "thing", "t", log, marks)
    assert file_log(spark, log).first()["offset"] > rows["m"]


def test_marks_never_fall_and_broken_publishing_is_found(spark):
    root = new_folder(spark, "polls")
    high, low = dt.datetime(2024, 3, 1, 1, 2, 3, 456789), dt.datetime(2024, 2, 1)
    assert advance_watermark(spark, root, "s", "e", high) and not advance_watermark(spark, root, "s", "e", low)
    assert not advance_watermark(spark, root, "s", "e", high) and current_watermark(spark, root, "s", "e") == high
    assert current_watermark(spark, root, "s", "other") is None and watermarks(spark, f"{root}/none").count() == 0
    log = f"{root}-log"
    events = encode_events(spark.createDataFrame([(1,), (2,)], "id long"), "s", "e", "INSERT")
    publish_to_file_log(events, log)
    last = file_log(spark, log).agg(F.max("offset")).first()[0]
    write_state(spark, f"{log}/_next_offset", '{"next": 0, "open": true}')  # as a call that broke off leaves it
    publish_to_file_log(events, log)
    offsets = [r["offset"] for r in file_log(spark, log).select("offset").collect()]
    assert len(set(offsets)) == 4 and sorted(offsets)[2] > last


def test_nested_paths(spark):
    docs = ['{"a":{"b":[1,2.5,null]},"c":null}', '{"a":{"b":"x"},"c":"2024-01-01"}', '[1]', "no json", None, '{"a":{}}', "7"]
    got = {r["path"]: (r["data_type"], r["n_values"], r["n_nulls"], r["row_count"])
           for r in infer_json_paths(spark.createDataFrame([(d,) for d in docs], "j string"), "j").collect()}
    assert got == {
        "$": ("string", 6, 0, 6), "$[]": ("integer", 1, 0, 6), "$.a": ("object", 3, 0, 6), "$.c": ("date", 2, 1, 6),
        "$.a.b": ("string", 2, 0, 6), "$.a.b[]": ("float", 3, 1, 6)}
    shallow = infer_json_paths(spark.createDataFrame([(d,) for d in docs], "j string"), "j", depth=1)
    assert {r["path"] for r in shallow.collect()} == {"$", "$[]", "$.a", "$.c"}
    assert infer_json_paths(spark.createDataFrame([], "j string"), "j").count() == 0
