"""Profile of JSON columns: types of odd values, worked out once for each value."""

from pyspark.sql import functions as F

from unirec.operators import profile
from unirec.operators.profile import infer_json_columns

DOCS = [
    ('a', '{"id":1,"n":1.5,"wide":12345678901234567890,"day":"2024-01-02","gone":null,"in":{"x":[1]},"same":1,"same":"t"}'),
    ('a', '{"id":2,"n":3,"wide":1,"day":"2024-01-03","gone":null,"in":[],"same":2}'),
    ('b', '{"day":"not a date","yes":true}'), ('b', None), ('b', 'no json'), (None, '{}'),
]


def test_types_of_odd_values(spark):
    rows = infer_json_columns(spark.createDataFrame(DOCS, "g string, doc string"), "doc", ["g"]).collect()
    got = {(r["g"], r["name"]): (r["data_type"], r["n_values"], r["n_nulls"], r["row_count"]) for r in rows}
    assert got == {
        ("a", "id"): ("integer", 2, 0, 2), ("a", "n"): ("float", 2, 0, 2), ("a", "wide"): ("integer", 2, 0, 2),
        ("a", "day"): ("date", 2, 0, 2), ("a", "gone"): ("string", 2, 2, 2), ("a", "in"): ("string", 2, 0, 2),
        ("a", "same"): ("string", 3, 0, 2), ("b", "day"): ("string", 1, 0, 3), ("b", "yes"): ("boolean", 1, 0, 3)}


def test_no_kind_is_worked_out_in_a_lambda(spark, monkeypatch, capsys):
    seen = []
    monkeypatch.setattr(profile, "stored", lambda df, name: seen.append(df) or df)
    infer_json_columns(spark.createDataFrame(DOCS, "g string, doc string").withColumn("k", F.lit(1)), "doc", ["g"])
    seen[0].explain()
    plan = capsys.readouterr().out
    assert "lambda" not in plan and plan.count("schemaOfVariant(") == 1
