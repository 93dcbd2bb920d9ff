"""Sharding by extendible hashing.

A directory is indexed by hash-prefix bits.  A bucket over the byte limit splits on the next bit, the others stay
as they are, until every shard fits.  The hash has 128 bits: 64 of the key columns, then 64 of the text, so that
rows of one hot key still split.  Rows that share all bits have the same key and text; if they alone exceed the
limit they are dealt to overflow pages of as many rows as fit.  A row larger than the limit is alone in its shard.

Null keys hash like any other value, null text has no bytes, repeated rows are dealt one by one, an empty table has
no shards.  Other columns are carried along; ``shard``, ``depth``, ``shard_bytes`` and names with a leading
underscore are the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unirec.functions.shared import stored
from unirec.llm.placing import with_running_total

BITS = 128
STEP = 8  # bits by which one round deepens the buckets that are still too large
# A directory of at most so many leaves (about 100 bytes each) is sent to all tasks; a larger one is joined by a shuffle.
SENT_LEAVES = 100_000


def hash_bits(*columns: Column) -> Column:
    """The first 64 bits of the MD5 of the columns' texts, as 0 and 1."""
    joined = F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns])
    return F.lpad(F.conv(F.substring(F.md5(joined.cast("binary")), 1, 16), 16, 2), 64, "0")


def row_bytes() -> Column:
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")


def row_bits(key: list[str]) -> Column:
    return F.concat(hash_bits(*[F.col(c) for c in key]), hash_bits(F.col("text")))


def directory(keyed: DataFrame, limit: int) -> DataFrame:
    """``keyed``: bits, bytes, copies (one row per hash).  Returns the leaves: prefix, depth, shard_bytes, n_rows.

    Each round sums the keys of the open buckets by prefixes up to ``STEP`` bits deeper.  A prefix is a node of the
    directory when all shorter ones were over the limit.  The rounds end when no bucket is open, at the latest
    when the bits are used up.
    """
    root = keyed.agg(F.sum("bytes").alias("shard_bytes"), F.sum("copies").alias("n_rows"))
    nodes = stored(
        root.filter("n_rows > 0").select(F.lit("").alias("prefix"), F.lit(0).alias("depth"), "shard_bytes", "n_rows"), "directory")
    leaves, depth = nodes.filter(F.col("shard_bytes") <= limit), 0
    while True:
        open_ = nodes.filter((F.col("shard_bytes") > limit) & (F.col("depth") == depth)).select("prefix")
        if depth == BITS or open_.isEmpty():
            return leaves.unionByName(nodes.filter((F.col("shard_bytes") > limit) & (F.col("depth") == BITS)))
        deeper = depth + STEP
        cells = (
            keyed.withColumn("prefix", F.substring("bits", 1, depth)).join(open_, "prefix", "left_semi")
            .groupBy(F.substring("bits", 1, deeper).alias("cell"))
            .agg(F.sum("bytes").alias("bytes"), F.sum("copies").alias("copies"))
        )
        level = (
            cells.select("*", F.explode(F.sequence(F.lit(depth + 1), F.lit(deeper))).alias("depth"))
            .groupBy(F.expr("substring(cell, 1, depth)").alias("prefix"), "depth")
            .agg(F.sum("bytes").alias("shard_bytes"), F.sum("copies").alias("n_rows"))
            .withColumn("parent", F.expr("substring(prefix, 1, depth - 1)"))
        )
        level = stored(level, "directory-level")
        split = level.filter(F.col("shard_bytes") > limit).select(F.col("prefix").alias("parent"))
        split = split.unionByName(open_.select(F.col("prefix").alias("parent")))
        nodes = stored(level.join(split, "parent", "left_semi").drop("parent"), "directory")
        leaves = leaves.unionByName(nodes.filter(F.col("shard_bytes") <= limit))
        depth = deeper


def assign_shards(docs: DataFrame, limit: int, key: list[str]) -> DataFrame:
    """``docs`` with shard, depth and shard_bytes.  A shard is named ``b`` + its prefix, overflow pages ``b…+page``."""
    keyed = stored(
        docs.select(row_bits(key).alias("bits"), row_bytes().alias("bytes"))
        .groupBy("bits").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("copies")), "shard-keys")
    leaves = stored(directory(keyed, limit), "shard-leaves")
    depths = F.array(*[F.lit(d) for d in sorted(r[0] for r in leaves.select("depth").distinct().collect()) or [0]])  # at most 129
    named = leaves.select("prefix", "depth", "shard_bytes", F.concat(F.lit("b"), "prefix").alias("shard"))

    def located(rows: DataFrame, sides: DataFrame) -> DataFrame:
        """``rows`` (with _bits) and the leaf of each: one of its prefixes is a leaf."""
        paths = rows.select("*", F.explode(depths).alias("_at")).withColumn("prefix", F.expr("substring(_bits, 1, _at)"))
        return paths.join(sides, "prefix").drop("prefix", "_at")

    own = docs.drop("shard", "depth", "shard_bytes").withColumn("_bits", row_bits(key))
    keys = keyed.select(F.col("bits").alias("_bits"), F.col("copies").alias("_copies"))
    over = F.col("shard_bytes") > limit
    if leaves.count() <= SENT_LEAVES:
        placed = located(own, F.broadcast(named.filter(~over))).drop("_bits")
    else:
        placed = own.join(located(keys, named.filter(~over)).drop("_copies"), "_bits").drop("_bits")
    large = stored(located(keys, named.filter(over)), "shard-overflow")
    if large.isEmpty():
        return placed
    paged = with_running_total(
        own.join(large, "_bits").withColumns({"_bytes": row_bytes(), "_order": F.monotonically_increasing_id()}),
        ["_bits"], ["_order"], "_bytes", "_start", "shard-pages")
    per_page = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("_bytes")))
    paged = paged.withColumn("_per", per_page).withColumn("_page", F.expr("(_start div _bytes) div _per"))
    paged = paged.withColumns({
        "shard": F.concat("shard", F.lit("+"), F.col("_page").cast("string")),
        "shard_bytes": F.least("_per", F.expr("_copies - _page * _per")) * F.col("_bytes"),
    })
    return placed.unionByName(paged.select(placed.columns))


def write_shards(docs: DataFrame, path: str, limit: int, key: list[str]) -> None:
    """One folder ``shard=…`` per shard; a task writes whole shards, each within the limit."""
    assign_shards(docs, limit, key).repartition("shard").write.partitionBy("shard").parquet(path)
