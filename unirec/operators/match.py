"""Which tables mean the same entity, and which columns mean the same field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from unirec.functions.names import entity_name, skeleton, snake
from unirec.spec import EntitySpec

# Sources of a match and the column that names their table.
MATCH_COLUMNS = {
    "postgres": "postgres_table", "sqlserver": "sqlserver_entity", "teradata": "teradata_table",
}


# The least similarity at which two names that share no signature are proposed.
LEAST_SIMILARITY = 0.4


def match_scores(catalog: DataFrame) -> DataFrame:
    """Per table: its canonical name, and how much of its columns other sources share (Jaccard)."""
    columns = catalog.select(
        entity_name(F.col("table")).alias("canonical_name"), "source", "table", snake(F.col("name")).alias("col"))
    per_table = columns.groupBy("canonical_name", "source", "table", "col").agg(F.lit(1).alias("one"))
    per_source = per_table.groupBy("canonical_name", "col", "source").agg(F.lit(1).alias("one"))
    holders = per_source.groupBy("canonical_name", "col").agg(
        F.count("*").alias("n_sources"), F.min("source").alias("only_source"))
    # Columns that sources other than S hold = all columns of the entity minus those only S holds.
    totals = holders.groupBy("canonical_name").agg(F.count("*").alias("n_all"))
    own_only = holders.filter("n_sources = 1").groupBy(
        "canonical_name", F.col("only_source").alias("source")).agg(F.count("*").alias("n_own_only"))
    shared = per_table.join(holders, ["canonical_name", "col"]).groupBy("canonical_name", "source", "table").agg(
        F.count("*").alias("n_columns"),
        F.sum(F.when(F.col("n_sources") > 1, 1).otherwise(0)).alias("n_shared"),
    )
    scored = shared.join(totals, "canonical_name").join(own_only, ["canonical_name", "source"], "left")
    n_others = F.col("n_all") - F.coalesce("n_own_only", F.lit(0))
    union = F.col("n_columns") + n_others - F.col("n_shared")
    return scored.select(
        "canonical_name", "source", "table", "n_columns", "n_shared", (F.col("n_shared") / union).alias("score"))


def match_entities(catalog: DataFrame) -> DataFrame:
    """One row per entity with its table in every source (null where a source has none).

    Tables that one source holds under the same canonical name are ranked by score, then by name.
    """
    best = Window.partitionBy("canonical_name", "source").orderBy(F.desc("score"), F.asc("table"))
    chosen = match_scores(catalog).withColumn("_rank", F.row_number().over(best)).filter("_rank = 1")
    wide = chosen.groupBy("canonical_name").pivot("source", list(MATCH_COLUMNS)).agg(F.min("table"))
    return wide.select("canonical_name", *[F.col(s).alias(c) for s, c in MATCH_COLUMNS.items()])


def active_sources(matches: DataFrame) -> DataFrame:
    """``canonical_name, source, table`` for every source that has the entity."""
    pairs = F.array(*[
        F.struct(F.lit(s).alias("source"), F.col(c).alias("table")) for s, c in MATCH_COLUMNS.items()])
    return matches.select("canonical_name", F.explode(pairs).alias("_s")).select("canonical_name", "_s.*").filter(
        F.col("table").isNotNull())


def matched_columns(matches: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalogue rows of the matched tables, with the entity they belong to."""
    return active_sources(matches).join(catalog, ["source", "table"])


def canonical_fields(specs: list[EntitySpec], like: DataFrame) -> DataFrame:
    """The fields of specs as rows: canonical_name, canonical_field, data_type."""
    rows = [(s.name, f.name, f.data_type) for s in specs for f in s.fields]
    return like.sparkSession.createDataFrame(rows, "canonical_name string, canonical_field string, data_type string")


def propose_fields(columns: DataFrame) -> DataFrame:
    """Canonical fields proposed from matched columns: one per normalised name, with a common type.

    ``id`` becomes ``<entity>_id``.  Types that disagree give a string, integer and float give float.
    """
    snaked = snake(F.col("name"))
    field = F.when(snaked == "id", F.concat("canonical_name", F.lit("_id"))).otherwise(snaked)
    named = columns.select("canonical_name", field.alias("canonical_field"), "data_type", "source")
    types = named.groupBy("canonical_name", "canonical_field").agg(
        F.count("*").alias("n_columns"),
        F.min("data_type").alias("low"), F.max("data_type").alias("high"),
        F.sum(F.when(F.col("data_type").isin("integer", "float"), 0).otherwise(1)).alias("n_other"),
    )
    kind = F.when(F.col("low") == F.col("high"), F.col("low")).when(F.col("n_other") == 0, "float").otherwise("string")
    return types.select("canonical_name", "canonical_field", kind.alias("data_type"), "n_columns")


def propose_mappings(columns: DataFrame, fields: DataFrame) -> DataFrame:
    """Source column -> canonical field, by equality of name signatures; the strongest rule wins.  What no signature
    brings together is matched by ``reciprocal_matches`` (rule 6).

    Rules, strongest first: the name itself; ``id`` for ``<entity>_id``; the name with a leading
    abbreviation of the entity written out; the name without the entity; the consonant skeleton of the
    last two.  Every rule is an equi-join inside the entity, so no pairs are tried out.
    """
    entity = F.col("canonical_name")

    def signatures(name, is_source: bool):
        first = F.regexp_extract(name, r"^([a-z0-9]+)_", 1)
        rest = F.regexp_replace(name, r"^[a-z0-9]+_", "")
        abbreviates = (F.length(first) >= 3) & entity.startswith(first)
        full = F.when(abbreviates, F.concat_ws("_", entity, rest)).otherwise(name)
        bare = F.when(name.startswith(F.concat(entity, F.lit("_"))), F.substring(name, F.length(entity) + 2, F.length(name)))
        short = F.when(abbreviates, rest) if is_source else F.coalesce(bare, name)
        alias = F.when(name == "id", F.concat(entity, F.lit("_id"))) if is_source else name
        plain = F.when(~abbreviates, name) if is_source else name
        return F.array(
            F.struct(F.lit(1).alias("rule"), name.alias("sig")),
            F.struct(F.lit(2).alias("rule"), alias.alias("sig")),
            F.struct(F.lit(3).alias("rule"), (full if is_source else name).alias("sig")),
            F.struct(F.lit(4).alias("rule"), short.alias("sig")),
            F.struct(F.lit(5).alias("rule"), skeleton(F.coalesce(short, plain)).alias("sig")),
        )

    left = columns.select(
        "canonical_name", "source", "table", F.col("name").alias("source_field"),
        F.explode(signatures(snake(F.col("name")), True)).alias("_s"),
    ).select("canonical_name", "source", "table", "source_field", "_s.rule", "_s.sig").filter(
        F.coalesce(F.col("sig"), F.lit("")) != "")
    right = fields.select(
        "canonical_name", "canonical_field", F.explode(signatures(F.col("canonical_field"), False)).alias("_s"),
    ).select("canonical_name", "canonical_field", "_s.rule", "_s.sig").filter(F.coalesce(F.col("sig"), F.lit("")) != "")
    hits = left.join(right, ["canonical_name", "rule", "sig"])
    best = Window.partitionBy("canonical_name", "source", "table", "source_field").orderBy("rule", "canonical_field")
    chosen = ["canonical_name", "source", "table", "source_field", "canonical_field", "rule"]
    named = hits.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1").select(*chosen)
    return named.unionByName(reciprocal_matches(columns, fields, named).select(*chosen))


def type_family(data_type: Column) -> Column:
    """Types that a mapping may lead between; text may hold anything, so it has none."""
    return (
        F.when(data_type.isin("integer", "float") | data_type.startswith("decimal"), "number")
        .when(data_type.isin("date", "timestamp"), "time").when(data_type == "boolean", "boolean")
    )


def reciprocal_matches(columns: DataFrame, fields: DataFrame, named: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """Source columns and canonical fields of one table that ``named`` leaves free, matched one to one: each is the
    other's most similar by edit distance (1 - distance / longer length, at least ``least``).

    Only names of one entity meet, and only where their lengths alone allow the similarity.  Types of different families
    never match; of equal similarities the one with the same type goes first, then the name that sorts first.
    """
    place = ["canonical_name", "source", "table"]

    def kind(df: DataFrame) -> Column:
        return F.col("data_type") if "data_type" in df.columns else F.lit(None).cast("string")

    free = columns.select(*place, F.col("name").alias("source_field"), kind(columns).alias("_kind")).join(
        named.select(*place, "source_field"), [*place, "source_field"], "left_anti")
    open_ = columns.select(*place).distinct().join(
        fields.select("canonical_name", "canonical_field", kind(fields).alias("_to_kind")), "canonical_name").join(
        named.select(*place, "canonical_field"), [*place, "canonical_field"], "left_anti")
    one, other = snake(F.col("source_field")), F.col("canonical_field")
    shorter, longer = F.least(F.length("_name"), F.length(other)), F.greatest(F.length("_name"), F.length(other))
    pairs = free.withColumn("_name", one).join(open_, place).filter(shorter >= longer * least)
    a, b = type_family(F.col("_kind")), type_family(F.col("_to_kind"))
    pairs = pairs.filter(a.isNull() | b.isNull() | (a == b))
    alike = pairs.withColumn("_alike", 1 - F.levenshtein("_name", other) / longer).filter(F.col("_alike") >= least)
    same = F.coalesce(F.col("_kind") == F.col("_to_kind"), F.lit(False))
    order = [F.desc("_alike"), same.desc()]
    for_source = Window.partitionBy(*place, "source_field").orderBy(*order, "canonical_field")
    for_field = Window.partitionBy(*place, "canonical_field").orderBy(*order, "source_field")
    ranked = alike.withColumns({"_first": F.row_number().over(for_source), "_second": F.row_number().over(for_field)})
    return ranked.filter("_first = 1 AND _second = 1").select(*place, "source_field", "canonical_field", F.lit(6).alias("rule"))
