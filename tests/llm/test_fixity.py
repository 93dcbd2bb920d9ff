from pyspark.sql import functions as F

from unirec.llm import fixity
from unirec.llm.fixity import archive, audit, merkle_levels, record_hashes, write_warc

PAGES = [(i, f"http://h/{i}", "<p>" + "é" * (i * 13 % 200) + "</p>") for i in range(300)]
PAGES += [(None, None, None), (400, None, ""), (7, "http://h/7", "again"), (7, "http://h/7", "again"), (500, "u", "z" * 100_000)]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, offset string")


def test_offsets_and_files(spark, tmp_path):
    records = archive(pages(spark))
    rows = sorted(records.collect(), key=lambda r: r.offset)
    at = 0
    for r in rows:
        assert r.offset == at and r.length == len(r.record.encode()) + 4
        at += r.length
    assert [r.page_id for r in rows][0] is None
    write_warc(records, f"{tmp_path}/warc")
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "warc").glob("part-*")))
    assert data == b"".join(r.record.encode() + b"\r\n\r\n" for r in rows)


def test_only_damaged_branches_are_read_and_all_damage_is_found(spark, monkeypatch):
    monkeypatch.setattr(fixity, "LEAF_BYTES", 2000)
    monkeypatch.setattr(fixity, "FANOUT", 3)
    records = archive(pages(spark)).cache()
    rows = {r.offset: r for r in records.collect()}
    offsets = sorted(rows)
    altered, lost = offsets[10], [offsets[0], offsets[200], offsets[-1]]
    replica = records.filter(~F.col("offset").isin(lost)).withColumn(
        "record", F.when(F.col("offset") == altered, F.concat("record", F.lit("!"))).otherwise(F.col("record")))
    replica = replica.unionByName(records.limit(1).select(F.lit(None).cast("long").alias("page_id"), F.lit(1).cast("long").alias("offset"),
                                                           F.lit(9).cast("long").alias("length"), F.lit("intruder").alias("record")))
    found = {r.offset: r.status for r in audit(records, replica).collect()}
    assert found == {altered: "altered", 1: "extra"} | {o: "missing" for o in lost}
    assert audit(records, records).count() == 0


def test_root_depends_on_order_and_content(spark):
    base = record_hashes(archive(pages(spark)))
    root = merkle_levels(base, 6)[-1].collect()
    assert len(root) == 1
    other = merkle_levels(base.withColumn("length", F.col("length") + (F.col("offset") == 0).cast("long")), 6)[-1].collect()
    assert root[0].hash != other[0].hash


def test_empty_archives(spark):
    empty = archive(pages(spark, []))
    assert audit(empty, empty).count() == 0
    assert {r.status for r in audit(archive(pages(spark)), empty).collect()} == {"missing"}
