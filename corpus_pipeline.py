"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, token-ID output.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept; its result is written as
Parquet and read again as the next one's ``docs``.  All but the last return the columns of ``documents``.

Whatever the stage, a null doc_id, lang or source is a value like any other, extra columns are dropped, and an empty table
gives an empty result.  A null text has no language, so the first stage drops it.  Rows that are equal in doc_id and text are
one document from the second stage on; of their other columns the smallest values stay, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unirec.functions.shared import new_folder, stored
from unirec.llm.decontaminate import decontaminate
from unirec.llm.language import UNKNOWN, identify, language_model
from unirec.llm.mixing import mix
from unirec.llm.probminhash import near_duplicates
from unirec.llm.registry import MIX_BLOCK_WORDS, MIX_SEED, MIX_SHARD_BLOCKS
from unirec.llm.text import table
from unirec.llm.token_codec import read_ids, write_ids

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# A document goes when it has no letter or no language reaches this share.
LEAST_SCORE = 0.3
# The workers of the last stage have run four others before; they remember fewer pieces than where tokens are all they make.
REMEMBERED_PIECES = 200_000


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS, F.xxhash64("text").alias("text_key"))


def only(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, text) is among ``chosen``: doc_id, text_key."""
    d, c = keyed(docs).alias("d"), chosen.alias("c").hint("merge")
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.text_key") == F.col("c.text_key"))
    return d.join(c, same, "left_semi").select(*COLUMNS)


def one_of_equal(docs: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each value of ``keys``: the smallest of the other columns, taken together."""
    rest = [c for c in docs.columns if c not in keys]
    return docs.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(*[c if c in keys else F.col("_row")[c].alias(c) for c in docs.columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that have a language."""
    found = identify(docs.select(*COLUMNS), language_model(docs), COLUMNS)
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class; of equal rows one."""
    kept = stored(near_duplicates(docs).filter("kept").select("doc_id", "text_key"), "kept")
    return one_of_equal(only(docs, kept), ["doc_id", "text"])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the contaminated documents."""
    clean = stored(decontaminate(docs, table(spark, sf_dir, "benchmark")).filter("NOT contaminated").select("doc_id", "text_key"), "clean")
    return only(docs, clean)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the words that the mix takes of them.  A row for each pass over a source: a document taken
    whole is as it was, one of which the mix takes some blocks has their words (each with the white space after it)."""
    d = keyed(docs)
    named = d.select(F.struct("doc_id", "text_key").alias("doc_id"), "text", "source")
    rows, draws = mix(named, MIX_BLOCK_WORDS, MIX_SHARD_BLOCKS, MIX_SEED)
    spans = draws.groupBy("row_id", "in_pass").agg(F.array_sort(F.collect_list(F.struct("first_word", "n_words"))).alias("spans"))
    spans = stored(rows.join(spans, "row_id").select("doc_id.*", "size", "spans"), "mix-spans")
    # Equal rows have spans each; their text is needed once.
    d, s = one_of_equal(d, ["doc_id", "text_key"]).alias("d"), spans.alias("s").hint("merge")
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.text_key") == F.col("s.text_key"))
    taken = d.join(s, same).select("d.*", "s.size", "s.spans")
    whole = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["n_words"]) == F.col("size")
    cut = F.expr(r"""array_join(flatten(transform(spans, s -> slice(
        regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*', 0), int(s.first_word) + 1, int(s.n_words)))), '')""")
    text = F.when(whole, F.col("text")).otherwise(cut)
    return taken.select("doc_id", text.alias("text"), "lang", "source", F.char_length(text).cast("long").alias("n_chars"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the ids and reads them back."""
    import public_tokenizers

    path = new_folder(spark, "tokens")
    write_ids(docs, public_tokenizers.path("byte_bpe_50k.json"), 0, path, REMEMBERED_PIECES)
    return read_ids(spark, path)


STAGES = [
    ("language ID", language_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
    ("token-ID output", token_stage),
]
# The language model cannot be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
