"""Profiles of sources: JSON column types over all rows, and merge-key candidates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unirec.functions.shared import stored
from unirec.functions.values import WIDE_INTEGER, kind_of


def looks_like_date(text: Column) -> Column:
    return (F.length(text) == 10) & (F.substring(text, 5, 1) == "-")


def json_type(value: Column, kind: Column | None = None) -> Column:
    """Type of one JSON value: boolean, integer, float, date, string; ``null`` for JSON null.  ``kind`` is its kind where
    that is a column already."""
    kind = kind_of(value) if kind is None else kind
    return (
        F.when(kind == "BOOLEAN", "boolean")
        .when((kind == "BIGINT") | (kind.startswith("DECIMAL") & kind.rlike(WIDE_INTEGER)), "integer")
        .when((kind == "DOUBLE") | kind.startswith("DECIMAL"), "float")
        .when((kind == "STRING") & looks_like_date(F.try_variant_get(value, "$", "string")), "date")
        .when(kind == "VOID", "null")
        .otherwise("string")
    )


def common_type(types: Column) -> Column:
    """Narrowest type that holds all seen types (null fits any; nothing but null is a string)."""
    seen = F.array_sort(F.array_remove(types, "null"))
    return (
        F.when(F.size(seen) == 1, F.get(seen, F.lit(0)))
        .when(seen == F.array(F.lit("float"), F.lit("integer")), "float")
        .otherwise("string")
    )


def infer_json_columns(docs: DataFrame, column: str, group: Sequence[str] = ()) -> DataFrame:
    """Columns of JSON objects over all rows: ``group``, name, data_type, n_values, n_nulls,
    is_primary_key (the column is called ``id``), and row_count of the group.

    Rows fold to one count per group, key and type before the shuffle.  Members become rows before their types are judged: a
    lambda over the members would be interpreted and work out the kind of a value once for every type it is compared with.
    """
    group = list(group)
    entries = F.map_entries(F.from_json(column, "map<string,variant>"))
    # The row itself counts under the null name, so that one pass gives columns and row count.
    row_mark = F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("variant").alias("value"))
    members = F.concat(F.array(row_mark), F.coalesce(entries, F.array().cast("array<struct<key:string,value:variant>>")))
    opened = docs.select(*group, F.explode(members).alias("_e")).select(*group, "_e.key", "_e.value")
    judged = opened.withColumn("_kind", kind_of(F.col("value")))
    kind = F.when(F.col("key").isNull(), "null").otherwise(json_type(F.col("value"), F.col("_kind")))
    counted = judged.groupBy(*group, F.col("key").alias("name"), kind.alias("type")).agg(F.count("*").alias("n"))
    folded = counted.groupBy(*group, "name").agg(
        F.collect_set("type").alias("types"),
        F.sum("n").alias("n_values"),
        F.sum(F.when(F.col("type") == "null", F.col("n")).otherwise(0)).alias("n_nulls"),
    )
    # A row per column and group: small, and kept, so that the documents are parsed once.
    folded = stored(folded, "json-columns")
    mark = F.to_json(F.struct(*group), {"ignoreNullFields": "false"}) if group else F.lit("all")
    folded = folded.withColumn("_group", mark)
    totals = folded.filter(F.col("name").isNull()).select("_group", F.col("n_values").alias("row_count"))
    return folded.filter(F.col("name").isNotNull()).join(totals, "_group").select(
        *group, "name", common_type(F.col("types")).alias("data_type"), "n_values", "n_nulls",
        (F.col("name") == "id").alias("is_primary_key"), "row_count")


def infer_json_paths(docs: DataFrame, column: str, group: Sequence[str] = (), depth: int = 8) -> DataFrame:
    """Paths of JSON documents, nested ones too, over all rows: ``group``, path, data_type, n_values, n_nulls, and row_count of
    the group.

    ``$.a.b`` is a member of a member and ``$.a[]`` every element of a list.  Containers count as ``object`` and ``array`` and are
    opened down to ``depth`` levels.  Text that is no JSON is a value ``$`` of type string.  The documents are read and parsed
    once: each level opens the containers of the level before it, and all values fold to one count per path and type.
    """
    group = list(group)
    parsed = F.try_parse_json(column)
    node = F.struct(F.lit("$").alias("path"), parsed.alias("value"), F.lit(0).alias("level"))
    nodes = docs.filter(F.col(column).isNotNull()).select(*group, node.alias("_n"))
    for level in range(depth):
        path, value, kind = F.col("_n.path"), F.col("_n.value"), kind_of(F.col("_n.value"))

        def child(name: Column, inner: Column) -> Column:
            return F.struct(F.concat(path, name).alias("path"), inner.alias("value"), F.lit(level + 1).alias("level"))

        members = F.transform(F.map_entries(F.try_variant_get(value, "$", "map<string,variant>")), lambda e: child(F.concat(F.lit("."), e["key"]), e["value"]))
        elements = F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda e: child(F.lit("[]"), e))
        inside = F.when(kind.startswith("OBJECT"), members).when(kind.startswith("ARRAY"), elements)
        opened = F.when(F.col("_n.level") == level, inside)
        nodes = nodes.select(*group, F.explode(F.concat(F.array("_n"), F.coalesce(opened, F.array().cast(opened_type())))).alias("_n"))
    kind = kind_of(F.col("_n.value"))
    # A member that is JSON null is a variant of kind VOID; no variant at all is text that is no JSON.
    found = (
        F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array")
        .when(F.col("_n.value").isNull(), F.when(F.col("_n.path") == "$", "string").otherwise("null")).otherwise(json_type(F.col("_n.value"))))
    counted = nodes.groupBy(*group, F.col("_n.path").alias("path"), found.alias("type")).agg(F.count("*").alias("n"))
    folded = counted.groupBy(*group, "path").agg(
        F.collect_set("type").alias("types"), F.sum("n").alias("n_values"),
        F.sum(F.when(F.col("type") == "null", F.col("n")).otherwise(0)).alias("n_nulls"))
    folded = stored(folded, "json-paths")
    mark = F.to_json(F.struct(*group), {"ignoreNullFields": "false"}) if group else F.lit("all")
    folded = folded.withColumn("_group", mark)
    totals = folded.filter("path = '$'").select("_group", F.col("n_values").alias("row_count"))
    return folded.join(totals, "_group").select(
        *group, "path", common_type(F.col("types")).alias("data_type"), "n_values", "n_nulls", "row_count")


def opened_type() -> str:
    return "array<struct<path:string,value:variant,level:int>>"


def merge_key_candidates(df: DataFrame, candidates: Sequence[Sequence[str]]) -> DataFrame:
    """Profile of possible merge keys: rows, distinct values, rows with a null, and whether the
    candidate identifies every row.

    One pass: every row is expanded once per candidate and folded to one row per value before the
    shuffle, so a value that most rows share costs no more than a rare one.  The columns stay as they are: a
    candidate fills its own and leaves those of the others null.
    """
    names = ["+".join(columns) for columns in candidates]
    used = list(dict.fromkeys(c for columns in candidates for c in columns))
    profiles = []
    for name, columns in zip(names, candidates):
        any_null = F.greatest(*[F.col(c).isNull() for c in columns]) if len(columns) > 1 else F.col(columns[0]).isNull()
        own = [(F.col(c) if c in columns else F.lit(None).cast(df.schema[c].dataType)).alias(f"v{i}") for i, c in enumerate(used)]
        profiles.append(F.struct(F.lit(name).alias("candidate"), any_null.alias("has_null"), *own))
    expanded = df.select(F.explode(F.array(*profiles)).alias("_p")).select("_p.*")
    values = [f"v{i}" for i in range(len(used))]
    per_value = expanded.groupBy("candidate", "has_null", *values).agg(F.count("*").alias("n"))
    profile = per_value.groupBy("candidate").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("has_null"), 0).otherwise(1)).alias("n_distinct"),
        F.sum(F.when(F.col("has_null"), F.col("n")).otherwise(0)).alias("n_null"),
    )
    return profile.withColumn(
        "is_key", (F.col("n_null") == 0) & (F.col("n_rows") == F.col("n_distinct")))
