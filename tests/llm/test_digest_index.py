import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from unirec.llm.digest_index import DigestIndex, digest, exact_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[(t or "").translate(LOWER)].append(d)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = True
        for d in sorted(ids, key=repr):
            kept = d == keep and left
            left = left and not kept
            out.append((d, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_groups_equal_brute_force(spark):
    rows = [(i, f"Text {i % 17} É") for i in range(200)] + [(300, "TEXT 3 É"), (301, "text 3 é"), (302, None), (303, ""), (None, "text 4 É"), (None, "alone")]
    rows += [(7, "text 7 É")] * 3 + [(400, "long " * 20000), (-5, "LONG " * 20000)]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, digest string")
    assert sorted(map(tuple, exact_dedup(df).collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_index_persists_and_a_batch_twice_changes_nothing(spark, tmp_path):
    from pyspark.sql import functions as F

    def batch(rows):
        return spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", digest(F.col("text")).alias("digest"))

    path = f"file:{tmp_path}/index"
    index = DigestIndex(spark, path, 4)
    index.ingest(batch([(1, "a"), (2, "A"), (3, "b")]))
    index.ingest(batch([(1, "a"), (2, "A"), (3, "b")]))
    index.ingest(batch([(9, "b"), (10, "c")]))
    assert sorted(r.keep_id for r in index.read().collect()) == [2, 3, 10]
    spark.sql(f"DROP TABLE {index.name}")  # an external table: its files stay
    again = DigestIndex(spark, path, 4)
    assert sorted(r.keep_id for r in again.read().collect()) == [2, 3, 10]
    plan = batch([(1, "a")]).join(again.read().hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_reopened_index_keeps_its_buckets(spark, tmp_path):
    """Another session with another catalogue and another wish for buckets."""
    path = str(tmp_path / "index")
    members = spark.range(5000).select(F.col("id").alias("doc_id"), digest(F.col("id").cast("string")).alias("digest"))
    DigestIndex(spark, path, 16).ingest(members)
    spark.sql(f"DROP TABLE {DigestIndex(spark, path, 16).name}")  # external: the files stay
    again = DigestIndex(spark, path, 20)
    assert again.buckets == 16
    again.ingest(members)
    again.ingest(members.withColumn("doc_id", F.col("doc_id") + 9000))
    assert again.read().count() == again.read().select("digest").distinct().count() == 5000
    assert spark.read.parquet(path).count() == 5000
    spark.range(1).write.parquet(str(tmp_path / "foreign"))
    with pytest.raises(ValueError):
        DigestIndex(spark, str(tmp_path / "foreign"), 4)
