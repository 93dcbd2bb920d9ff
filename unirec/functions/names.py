"""Table and column names in one spelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def snake(name: Column) -> Column:
    """Lower snake_case: camel humps and every other separator become underscores."""
    humps = F.regexp_replace(name, r"([a-z0-9])([A-Z])", r"$1_$2")
    return F.regexp_replace(F.regexp_replace(F.lower(humps), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def singular(name: Column) -> Column:
    """English singular of the last word by its ending."""
    return (
        F.when(name.rlike(r"[a-z]ies$"), F.regexp_replace(name, r"ies$", "y"))
        .when(name.rlike(r"(ss|x|ch|sh)es$"), F.regexp_replace(name, r"es$", ""))
        .when(name.rlike(r"[a-z]s$") & ~name.rlike(r"(ss|us|is)$"), F.regexp_replace(name, r"s$", ""))
        .otherwise(name)
    )


def entity_name(table: Column) -> Column:
    """Canonical entity name of a table: without its schema, singular, snake_case."""
    return singular(snake(F.regexp_replace(table, r"^.*\.", "")))


def skeleton(name: Column) -> Column:
    """Consonant skeleton: vowels after a word's first letter go, then repeats collapse."""
    return F.regexp_replace(F.regexp_replace(name, r"(?<=[a-z0-9])[aeiou]", ""), r"([a-z])\1+", "$1")
