"""Key discovery against all sets counted exactly, and specs that take its answer."""

from itertools import combinations

import pytest
from pyspark.sql import functions as F

from unirec.operators import keys
from unirec.operators.keys import best_key, discover_merge_keys, plausible
from unirec.spec import CanonicalField, EntitySpec, FieldMapping


def by_hand(rows, columns, most):
    keys = []
    for size in range(1, most + 1):
        for s in combinations(range(len(columns)), size):
            values = [tuple(r[i] for i in s) for r in rows]
            if any(k <= set(s) for k in keys) or any(None in v for v in values) or len(set(values)) < len(values):
                continue
            keys.append(set(s))
    return sorted("+".join(columns[i] for i in sorted(k)) for k in keys)


@pytest.mark.parametrize("most", [1, 2, 3])
def test_minimal_keys_equal_brute_force(spark, most):
    columns = ["a", "b", "c", "d", "e"]
    rows = [(i // 10, i % 10, i * 7 % 500, None if i == 3 else i, i // 2) for i in range(400)] + [(40, 0, 0, 999, 200)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, e int")
    assert sorted(r["candidate"] for r in discover_merge_keys(df, most=most).collect()) == by_hand(rows, columns, most)


def test_pruning_and_empty_tables(spark):
    df = spark.range(10_000).selectExpr("id", "id % 3 AS few", "id % 7 AS some", "CAST(NULL AS INT) AS none")
    search = plausible(df, df.columns, 3)
    assert next(search) == (1, [("id",)])
    assert search.send([("id",)]) == (2, [])  # 3 x 7 values are too few, and the others hold a key
    assert best_key(discover_merge_keys(df)) == ["id"]
    assert discover_merge_keys(df.limit(0)).count() == 0 and best_key(discover_merge_keys(df.select("few"))) is None


def test_no_pass_takes_all_rows_of_a_set_that_repeats(spark, monkeypatch):
    monkeypatch.setattr(keys, "SLICE_VALUES", 500)
    df = spark.range(20_000).selectExpr("id DIV 2 AS a", "id % 1000 AS b", "id % 20000 AS c", "IF(id = 7, 8, id) AS d")
    search = plausible(df, df.columns, 2)
    # d repeats one value only, so only the check over all rows can find it.
    assert set(next(search)[1]) <= {("c",), ("d",)}
    assert search.send([("c",)])[0] == 2
    values = keys._values(df, [("a", "b"), ("a", "d")], F.lit(40))
    assert 0 < values.count() < 20_000 * 2 / 10
    assert keys.without_repeats_in_slice(df, [("a",), ("c",)], 20_000) == [("c",)]
    assert keys.without_repeats(df, [("d",), ("c",), ("a", "d"), ("b", "d")]) == [("c",), ("a", "d"), ("b", "d")]
    assert [r["candidate"] for r in discover_merge_keys(df, most=1).collect()] == ["c"]


def test_equal_numbers_with_other_bits_repeat(spark):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 1), (1.0, 2)], "x double, y int")
    assert discover_merge_keys(df).count() == 0
    nan = spark.range(2).selectExpr("double('NaN') AS x", "id")
    assert [r["candidate"] for r in discover_merge_keys(nan).collect()] == ["id"]


def test_spec_takes_the_found_keys(spark):
    spec = EntitySpec("item", (CanonicalField("order_id", "integer"), CanonicalField("line", "integer")),
                      sql_mappings=(FieldMapping("OrderNo", "order_id"), FieldMapping("LineNo", "line")))
    assert spec.with_merge_keys(["ORDERNO", "lineno"], "sql_mappings").keys() == ["order_id", "line"]
    assert spec.with_merge_keys(["line"]).keys() == ["line"]
    with pytest.raises(ValueError):
        spec.with_merge_keys(["nowhere"])
