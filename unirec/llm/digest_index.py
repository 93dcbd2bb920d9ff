"""Exact dedup: a persistent digest index, bucketed and sorted by hash.

New data is reduced to one row per digest, anti-joined with the index by sort-merge, and what is new is appended.
Ingesting a batch twice changes nothing, so a failed run can simply be repeated.

Null text counts as empty, so all null and empty texts are one group.  Rows that repeat a doc_id and a text are
one document given several times: each row is returned, one of them is kept.  A null doc_id is the smallest.
Other columns are ignored, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from unirec.functions.shared import child_names, new_folder, read_state, stored, write_state
from unirec.llm.text import lower_ascii


COUNT = "_buckets"


def digest(text: Column) -> Column:
    """SHA-256 of the lower-cased (A-Z) UTF-8 text, as bytes."""
    return F.unhex(F.sha2(lower_ascii(F.coalesce(text, F.lit(""))).cast("binary"), 256))


class DigestIndex:
    """``digest -> keep_id`` in a bucketed table at ``path``.

    The bucket count is fixed when the index is created and kept with its files; whoever opens it later, in whatever
    session, gets that count.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        known = read_state(spark, f"{path}/{COUNT}")
        if known is None:
            if any(n.endswith(".parquet") for n in child_names(spark, path)):
                raise ValueError(f"{path} holds files but no bucket count")
            write_state(spark, f"{path}/{COUNT}", str(buckets))
        self.spark, self.path, self.buckets = spark, path, int(known or buckets)
        self.name = "digest_index_" + hashlib.sha256(path.encode()).hexdigest()[:24]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def ingest(self, members: DataFrame) -> None:
        """``members``: doc_id, digest.  Of equal texts inside the batch the largest doc_id enters; digests that the
        index has already keep their entry."""
        batch = members.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        fresh = batch.join(self.read().hint("merge"), "digest", "left_anti").select("digest", "keep_id")
        fresh.repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.name)


def bucket_count(rows: int, rows_per_bucket: int = 1_000_000, least: int = 16) -> int:
    """Buckets of about 40 MB (40 bytes an entry)."""
    return max(least, math.ceil(rows / rows_per_bucket))


def exact_dedup(docs: DataFrame, index_path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    The table enters the index in two batches, the upper half of the ids first, so that the largest id of each
    group is the one that stays.
    """
    spark = docs.sparkSession
    members = stored(
        docs.select("doc_id", digest(F.col("text")).alias("digest")).groupBy("digest", "doc_id").agg(F.count("*").alias("copies")),
        "members")
    low, high, rows = members.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    index = DigestIndex(spark, index_path or new_folder(spark, "digest-index"), bucket_count(rows))
    middle = 0 if low is None else low + (high - low) // 2
    upper = F.coalesce(F.col("doc_id") > middle, F.lit(False))
    for half in (upper, ~upper):
        index.ingest(members.filter(half))
    sizes = members.groupBy("digest").agg(F.sum("copies").alias("group_size"))
    groups = stored(sizes.join(index.read(), "digest"), "groups")
    # A group may hold a third of all rows: a plain shuffle join, so that its partition can be split.
    return (
        members.join(groups, "digest")
        .select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
        .select(
            "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )
