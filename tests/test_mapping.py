"""Mapping rules as literal expected rows, on both routes."""

import datetime as dt
import decimal
import json

import pytest
from pyspark.sql import functions as F

from unirec.operators.mapping import apply_canonical_mapping, canonicalise
from unirec.spec import CanonicalField, EntitySpec, FieldMapping, resolve_transform


def spec_of(fields, mappings, **groups):
    return EntitySpec(
        "thing",
        tuple(CanonicalField(n, t) for n, t in fields),
        pg_mappings=tuple(FieldMapping(*m) for m in mappings),
        **{g: tuple(FieldMapping(*m) for m in ms) for g, ms in groups.items()},
    )


def run(spark, spec, payloads, mode="strict", source="postgres"):
    rows = [(i, p, source) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "i int, payload string, source string")
    mapped = apply_canonical_mapping(df, spec, mode)
    extra = ["_errors"] if mode == "lenient" else []
    return [r for r in mapped.orderBy("i").select("canonical.*", *extra).collect()]


@pytest.mark.parametrize("hint, op", [
    (None, "identity"), ("", "identity"), ("TRIM", "identity"), ("upper(name)", "upper"), ("Lower", "lower"),
    ("CAST AS INTEGER", "int"), ("cast as float", "float"), ("UPPER then LOWER", "upper"), ("cast(x as int)", "identity"),
])
def test_transform_hint(hint, op):
    assert resolve_transform(hint) == op


def test_key_spelling_and_last_entry(spark):
    spec = spec_of([("x", "integer"), ("y", "string")], [("Id", "x"), ("name", "y")])
    got = run(spark, spec, [
        '{"Id":1,"name":"a"}', '{"ID":2,"NAME":"b"}', '{"iD":3,"nAme":"c"}', '{"id":4,"zzz":9}',
        '{"Id":5,"ID":6}', '{"ID":7,"Id":8}', '{"Id":9,"id":null}', '{"Id":1,"Id":2}', '{"Id":null,"zz":{"Id":4}}',
    ])
    assert [(r.x, r.y) for r in got] == [
        (1, "a"), (2, "b"), (3, "c"), (4, None), (6, None), (8, None), (None, None), (2, None), (None, None)]


def test_two_source_fields_on_one_target(spark):
    spec = spec_of([("x", "string")], [("a", "x"), ("b", "x")])
    got = run(spark, spec, ['{"a":"1","b":"2"}', '{"b":"2","a":"1"}', '{"a":"1"}', '{"a":"1","B":null}'])
    assert [r.x for r in got] == ["2", "1", "1", None]


def test_colliding_spellings_later_mapping_wins(spark):
    spec = spec_of([("p", "integer"), ("q", "integer")], [("Id", "p"), ("ID", "q")])
    got = run(spark, spec, ['{"Id":1}', '{"ID":2}', '{"id":3}', '{"iD":4}'])
    assert [(r.p, r.q) for r in got] == [(1, None), (None, 2), (None, 3), (None, 4)]


def test_bad_payload_is_all_null(spark):
    spec = spec_of([("x", "integer")], [("a", "x")])
    got = run(spark, spec, [None, "", "bad", "[1]", '"s"', "12", "{'a':1}", '{"a":1,', "null"])
    assert [r.x for r in got] == [None] * 9


def test_source_picks_mapping_list(spark):
    spec = spec_of([("x", "string")], [("a", "x")], sql_mappings=[("b", "x")], td_mappings=[("c", "x")])
    payload = '{"a":"pg","b":"sql","c":"td"}'
    df = spark.createDataFrame(
        [(s, payload) for s in ("postgres", "sqlserver", "teradata", "other", None)], "source string, payload string")
    got = apply_canonical_mapping(df, spec).select("canonical.x").collect()
    assert [r.x for r in got] == ["pg", "sql", "td", "td", "td"]


def both_routes(values):
    """The same values under the declared spelling and under another one."""
    return ['{"v":%s}' % v for v in values] + ['{"V":%s}' % v for v in values]


UPPER_CASES = ['"ab"', '""', "0", "false", "true", "null", "12", "1.50", "100.0", '"false"', '{"z":"q","a":1}', "[]", "[1, 2]"]


@pytest.mark.parametrize("op, want", [
    ("UPPER", ["AB", "", "0", "false", "TRUE", None, "12", "1.5", "100.0", "FALSE", '{"Z":"Q","A":1}', "[]", "[1,2]"]),
    ("LOWER", ["ab", "", "0", "false", "true", None, "12", "1.5", "100.0", "false", '{"z":"q","a":1}', "[]", "[1,2]"]),
    (None, ["ab", "", "0", "false", "true", None, "12", "1.5", "100.0", "false", '{"z":"q","a":1}', "[]", "[1,2]"]),
])
@pytest.mark.parametrize("mode", ["strict", "lenient"])
def test_text_transforms(spark, op, want, mode):
    spec = spec_of([("x", "string")], [("v", "x", op)])
    got = [r.x for r in run(spark, spec, both_routes(UPPER_CASES), mode)]
    assert got[: len(want)] == want
    assert got[len(want):] == want


INT_CASES = ["12", "12.7", "-12.7", '" 12 "', '"12.5"', "true", "false", "null", '"x"', '"1_000"', '"+7"', "[1]", "1e3",
             "99999999999999999999"]


def test_cast_int_strict_empties_the_record(spark):
    spec = spec_of([("x", "integer"), ("y", "string")], [("v", "x", "CAST AS INT"), ("w", "y")])
    want = [12, 12, -12, 12, "bad", 1, 0, None, "bad", 1000, 7, "bad", 1000, None]
    payloads = ['{"v":%s,"w":"k"}' % v for v in INT_CASES] + ['{"V":%s,"w":"k"}' % v for v in INT_CASES]
    got = run(spark, spec, payloads)
    expected = [(None, None) if w == "bad" else (w, "k") for w in want]
    assert [tuple(r) for r in got] == expected * 2


def test_cast_int_lenient_empties_the_field(spark):
    spec = spec_of([("x", "integer"), ("y", "string")], [("v", "x", "CAST AS INT"), ("w", "y")])
    want = [12, 12, -12, 12, "bad", 1, 0, None, "bad", 1000, 7, "bad", 1000, "bad"]
    got = run(spark, spec, ['{"v":%s,"w":"k"}' % v for v in INT_CASES], "lenient")
    assert [tuple(r) for r in got] == [(None, "k", ["x"]) if w == "bad" else (w, "k", []) for w in want]


def test_cast_float(spark):
    spec = spec_of([("x", "float")], [("v", "x", "CAST AS FLOAT")])
    cases = ["12", "1.5", '" 1.5 "', '"1e3"', '"inf"', '"-Infinity"', '"1.5d"', '"0x1p3"', "true", "null", '"abc"', '".5"', '"5."', '"1_0.5"']
    want = [12.0, 1.5, 1.5, 1000.0, float("inf"), float("-inf"), None, None, 1.0, None, None, 0.5, 5.0, 10.5]
    got = [r.x for r in run(spark, spec, both_routes(cases))]
    assert got[: len(want)] == want
    assert got[len(want):] == want
    nan = run(spark, spec, both_routes(['"nan"', '"NaN"']))
    assert all(r.x != r.x for r in nan)


def test_refused_cast_counts_even_when_replaced(spark):
    spec = spec_of([("x", "integer")], [("v", "x", "CAST AS INT")])
    got = run(spark, spec, ['{"v":"z","V":5}', '{"v":5,"V":"z"}', '{"v":4,"V":5}'])
    assert [r.x for r in got] == [None, None, 5]


def test_declared_types_strict(spark):
    fields = [("i", "integer"), ("f", "float"), ("b", "boolean"), ("d", "date"), ("t", "timestamp"), ("s", "decimal")]
    spec = spec_of(fields, [(n, n) for n, _ in fields])
    rows = [
        ("12", "1.5", "true", '"2024-01-02"', '"2024-01-02T03:04:05Z"', "1.5"),
        ('"12"', '"1.5"', '"true"', '"2024-01-02T00:00:00"', '"2024-01-02 03:04:05"', '"x"'),
        ("12.0", "3", "1", '"nope"', "1700000000", "7"),
        ("12.5", '"NaN"', "0", "20240102", '"2024-01-02T03:04:05.123456+02:00"', "true"),
        ("true", "true", "null", "null", "1.5", "null"),
    ]
    utc = dt.datetime
    want = [
        (12, 1.5, True, dt.date(2024, 1, 2), utc(2024, 1, 2, 3, 4, 5), "1.5"),
        (None, None, None, dt.date(2024, 1, 2), utc(2024, 1, 2, 3, 4, 5), "x"),
        (None, 3.0, None, None, utc(2023, 11, 14, 22, 13, 20), "7"),
        (None, "nan", None, None, utc(2024, 1, 2, 1, 4, 5, 123456), "true"),
        (None, None, None, None, None, None),
    ]
    names = [n for n, _ in fields]
    straight = ["{" + ",".join(f'"{n}":{v}' for n, v in zip(names, r)) + "}" for r in rows]
    shouted = [s.replace('"i":', '"I":') for s in straight]
    got = [tuple("nan" if isinstance(v, float) and v != v else v for v in r) for r in run(spark, spec, straight + shouted)]
    assert got[:5] == want
    assert got[5:] == want


def test_declared_types_lenient(spark):
    fields = [("i", "integer"), ("f", "float"), ("b", "boolean"), ("d", "date"), ("t", "timestamp")]
    spec = spec_of(fields, [(n, n) for n, _ in fields])
    straight = [
        '{"i":"12","f":"1.5","b":"true","d":"2024-01-02","t":"2024-01-02 03:04:05"}',
        '{"i":12.0,"f":3,"b":1,"d":"nope","t":1700000000}',
        '{"i":"12.5","f":"x","b":"maybe","d":null,"t":"later"}',
    ]
    want = [
        (12, 1.5, True, dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5), []),
        (12, 3.0, True, None, dt.datetime(2023, 11, 14, 22, 13, 20), ["d"]),
        (None, None, None, None, None, ["i", "f", "b", "t"]),
    ]
    shouted = [s.replace('"i":', '"I":') for s in straight]
    assert [tuple(r) for r in run(spark, spec, straight + shouted, "lenient")] == want * 2


def test_transforms_on_other_types(spark):
    fields = [("a", "integer"), ("b", "float"), ("c", "string"), ("d", "timestamp"), ("e", "string")]
    spec = spec_of(fields, [("a", "a", "UPPER"), ("b", "b", "CAST AS INT"), ("c", "c", "CAST AS INT"),
                            ("d", "d", "CAST AS INT"), ("e", "e", "CAST AS FLOAT")])
    got = run(spark, spec, ['{"a":0,"b":"3","c":4.9,"d":"1700000000","e":"1.50"}', '{"a":5,"b":null,"c":"x"}'])
    assert tuple(got[0]) == (0, 3.0, "4", dt.datetime(2023, 11, 14, 22, 13, 20), "1.5")
    assert tuple(got[1]) == (None,) * 5


def test_unmapped_target_still_empties_the_record(spark):
    spec = spec_of([("x", "string")], [("a", "x"), ("b", "gone", "CAST AS INT")])
    got = run(spark, spec, ['{"a":"k","b":"1"}', '{"a":"k","b":"z"}'])
    assert [r.x for r in got] == ["k", None]


def test_routes_agree_on_mixed_rows(spark):
    """Every combination of values: declared spelling against lower-case spelling of one key."""
    spec = spec_of(
        [("n", "string"), ("k", "integer"), ("m", "float")],
        [("Name", "n", "UPPER"), ("Key", "k", "CAST AS INT"), ("Money", "m", "CAST AS FLOAT")])
    values = ['"x"', "null", "0", "1.25", "false", "true", '" 3 "', '"3.5"', "[]", '{"q":1}', '"nan"', "1e2"]
    straight = [f'{{"Name":{a},"Key":{b},"Money":{c}}}' for a in values for b in values for c in values]
    other = [s.replace('"Key"', '"key"') for s in straight]
    for mode in ("strict", "lenient"):
        got = [str(r) for r in run(spark, spec, straight + other, mode)]
        assert got[: len(straight)] == got[len(straight):]


def test_one_parse_per_route_and_no_python(spark):
    spec = spec_of([("x", "string"), ("y", "integer")], [("a", "x"), ("b", "y")],
                   sql_mappings=[("c", "x")], td_mappings=[("d", "x")])
    df = spark.createDataFrame([("{}", "postgres")], "payload string, source string").withColumn(
        "event_type", F.lit("INSERT")).withColumn("event_timestamp", F.lit("t"))
    plan = canonicalise(df, spec)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 4
    assert "Python" not in plan


def test_spec_round_trip():
    doc = {"canonical_schema": [{"name": "thing_id", "data_type": "integer", "nullable": False}],
           "pg_mappings": [{"source": "postgres", "source_field": "id", "canonical_field": "thing_id", "transform": None}],
           "merge_keys": None}
    spec = EntitySpec.from_document("thing", json.dumps(doc))
    assert spec.keys() == ["thing_id"]
    assert EntitySpec.from_document("thing", spec.to_document()) == spec


@pytest.mark.parametrize("mode", ["strict", "lenient"])
def test_sized_decimals_are_exact_on_both_routes(spark, mode):
    D = decimal.Decimal
    spec = spec_of([("a", "decimal(18,2)"), ("b", "decimal(38,10)"), ("c", "decimal(5,1)")], [("A", "a"), ("B", "b"), ("C", "c", "CAST AS FLOAT")])
    values = [
        ("9007199254740993.01", "12345678901234567890.0123456789", "1.25"), ('"9007199254740993.01"', '"0.1"', '"1_0.5"'), ("0.005", "1e3", "true"),
        ("12345678901234567.89", "7", "99999.9"), ('" 1.5 "', "null", "null"), ('"x"', '"1,000"', "0"), ("-1", "-0.00000000005", "-2")]
    want = [
        (D("9007199254740993.01"), D("12345678901234567890.0123456789"), D("1.3")), (D("9007199254740993.01"), D("0.1"), D("10.5")),
        (D("0.01"), D(1000), D(1)), (None, D(7), None), (D("1.5"), None, None), (None, None, D(0)), (D(-1), D("-0.0000000001"), D(-2))]
    for keys in (("A", "B", "C"), ("A", "b", "C"), ("A", "B", "c")):  # declared, and spelled in ways that take the general route
        got = run(spark, spec, ["{" + ",".join(f'"{k}":{v}' for k, v in zip(keys, row)) + "}" for row in values], mode)
        assert [tuple(r)[:3] for r in got] == want
    if mode == "lenient":
        assert [r["_errors"] for r in got] == [[], [], [], ["a", "c"], [], ["a", "b"], []]


def test_sized_decimals_of_simple_fields_use_the_direct_route(spark):
    spec = spec_of([("a", "decimal(18,2)")], [("A", "a")])
    assert [tuple(r) for r in run(spark, spec, ['{"A": 1.005}', '{"a": "2.345"}', '{"A": true}', '{"A": {"x": 1}}'])] == [
        (decimal.Decimal("1.01"),), (decimal.Decimal("2.35"),), (None,), (None,)]
    assert spec_of([("a", "decimal")], [("A", "a")]).schema["a"].dataType.simpleString() == "string"
    for bad in ("decimal(39,2)", "decimal(5,6)", "decimal(0,0)"):
        with pytest.raises(ValueError):
            CanonicalField("a", bad).spark_type


def test_strict_refuses_text_after_the_value(spark):
    spec = spec_of([("x", "integer"), ("n", "string")], [("id", "x"), ("n", "n")])
    payloads = ['{"id": 1}', '{"id": 2} ', '{"id": 3} x', '{"id": 4}{"id": 5}', '{"id": 6},{"id": 7}', '{"id": 8}}', '{"id": 9, "n": {"a": {}}}\n', '{"id": 10, "n": "}"}']
    assert [r["x"] for r in run(spark, spec, payloads)] == [1, 2, None, None, None, None, 9, 10]
    assert [r["x"] for r in run(spark, spec, payloads, "lenient")] == [1, 2, 3, 4, 6, 8, 9, 10]
