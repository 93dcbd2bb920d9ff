"""Merkle fixity audit of WARC archives.

Pages become WARC records in the order of their ids; a record's offset is the sum of the lengths before it.  A
replica is hashed record by record; a leaf of its tree is the hash of the records that begin in one range of
``LEAF_BYTES`` of the archive, in order of offset, and each level above hashes ``FANOUT`` neighbouring ranges.  Two
replicas are compared from the root down: only the children of nodes that differ are looked at, and in the end only
the records of leaves that differ.  A record counts as altered (other bytes at the offset), missing or extra.

A level is a table, so no node or list of records passes through the driver; it gets the number of levels.

Null url, html and page_id are written as empty fields, null ids first; rows that repeat are records of their own;
extra columns are ignored; two empty archives agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from unirec.functions.shared import stored

LEAF_BYTES = 1 << 20
FANOUT = 16


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """One ``resource`` record without its closing two line ends."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body)


def archive(pages: DataFrame) -> DataFrame:
    """page_id, offset, length, record.

    Records are dealt by ranges of their order, which moves them once; each range adds up its own lengths as it is
    written, and gets the length of the ranges before it by a table of one row per shuffle partition.
    """
    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            ends = before + np.cumsum(batch.column(1).to_numpy())
            begin = pa.array(ends - batch.column(1).to_numpy(), pa.int64())
            before = int(ends[-1]) if len(ends) else before
            yield pa.RecordBatch.from_arrays([*batch.columns, begin], names=["page_id", "length", "record", "part", "begin"])

    records = pages.select(F.col("page_id").cast("long").alias("page_id"), warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
    records = records.select("page_id", (F.octet_length("record").cast("long") + 4).alias("length"), "record")
    dealt = records.repartitionByRange("page_id").sortWithinPartitions("page_id", "record").withColumn("part", F.spark_partition_id())
    placed = stored(dealt.mapInArrow(lengths, "page_id long, length long, record string, part int, begin long"), "archive")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.sum("length").alias("n")).select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    return placed.join(F.broadcast(parts), "part").select("page_id", (F.col("begin") + F.col("ahead")).alias("offset"), "length", "record")


def write_warc(records: DataFrame, path: str) -> None:
    """The records as WARC files, in order of offset; each part is a file that begins with a record."""
    records.repartitionByRange("offset").sortWithinPartitions("offset").select("record").write.option("lineSep", "\r\n\r\n").text(path)


def record_hashes(replica: DataFrame) -> DataFrame:
    """offset, length, sha256 (hex) of every record."""
    return replica.select("offset", F.octet_length("record").cast("long").alias("length"), F.sha2(F.col("record").cast("binary"), 256).alias("sha256"))


def joined_hash(order: str, value: str) -> Column:
    """Hash of a bounded list of hashes in order."""
    return F.sha2(F.to_json(F.array_sort(F.collect_list(F.struct(order, value)))).cast("binary"), 256)


def merkle_levels(hashes: DataFrame, levels: int) -> list[DataFrame]:
    """``hashes``: offset, length, sha256.  Level 0 has a node per range, the last one the root: node, hash."""
    own = hashes.select(F.expr(f"offset div {LEAF_BYTES}").alias("node"), "offset", F.concat_ws(":", "sha256", F.col("length").cast("string")).alias("value"))
    out = [stored(own.groupBy("node").agg(joined_hash("offset", "value").alias("hash")), "merkle")]
    for _ in range(levels):
        parents = out[-1].select(F.col("node").alias("child"), "hash", F.expr(f"node div {FANOUT}").alias("node"))
        out.append(stored(parents.groupBy("node").agg(joined_hash("child", "hash").alias("hash")), "merkle"))
    return out


def differing(one: DataFrame, two: DataFrame, key: str, value: str) -> DataFrame:
    """Keys at which two tables differ, with both values; a side without the key has null."""
    pair = one.select(key, F.col(value).alias("one")).join(two.select(key, F.col(value).alias("two")), key, "full_outer")
    return pair.filter(~F.col("one").eqNullSafe(F.col("two")))


def audit(one: DataFrame, two: DataFrame) -> DataFrame:
    """Records (offset, record) that differ between two replicas: offset, sha256, replica_sha256, status."""
    hashes = [stored(record_hashes(r), "record-hashes") for r in (one, two)]
    end = max((h.agg(F.max("offset")).first()[0] or 0) for h in hashes)
    levels, top = 0, end // LEAF_BYTES
    while top:
        levels, top = levels + 1, top // FANOUT
    trees = [merkle_levels(h, levels) for h in hashes]
    open_ = stored(differing(trees[0][levels], trees[1][levels], "node", "hash").select("node"), "merkle-open")
    for level in range(levels - 1, -1, -1):
        if open_.isEmpty():
            break
        parents = open_.withColumnRenamed("node", "parent")
        below = [t[level].withColumn("parent", F.expr(f"node div {FANOUT}")).join(parents, "parent", "left_semi") for t in trees]
        open_ = stored(differing(*below, "node", "hash").select("node"), "merkle-open")
    leaves = [h.withColumn("node", F.expr(f"offset div {LEAF_BYTES}")).join(open_, "node", "left_semi") for h in hashes]
    found = differing(*leaves, "offset", "sha256")
    status = F.when(F.col("two").isNull(), "missing").when(F.col("one").isNull(), "extra").otherwise("altered")
    return found.select("offset", F.col("one").alias("sha256"), F.col("two").alias("replica_sha256"), status.alias("status"))


def decayed(records: DataFrame, every: int) -> DataFrame:
    """A replica with faults that can be told from the page ids: of every ``every`` ids one record has a byte changed
    and one is lost."""
    rest = F.pmod(F.coalesce("page_id", F.lit(0)) * 7919, F.lit(every))
    spoiled = F.when(rest == 0, F.concat(F.lit("X"), F.expr("substring(record, 2)"))).otherwise(F.col("record"))
    return records.filter(rest != 1).withColumn("record", spoiled)
