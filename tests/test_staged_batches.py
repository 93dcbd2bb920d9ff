"""A batch lies in files while its sinks are written, and in no cache: an executor's memory does not hold its rows."""

import pytest
from pyspark.sql import functions as F

from unirec.functions.shared import child_names, new_folder
from unirec.plans.derived import CUSTOMER, INGEST_DATE, as_log, customer_source
from unirec.sources.envelope import encode_events
from unirec.sources.topics import file_log_stream
from unirec.streaming.entity import EntityStream

CLEAN, NO_KEY, BROKEN = 40, 3, 2


def customer_log(spark) -> str:
    """Events with a key, events without one and rows that are no envelope."""
    folder = new_folder(spark, "own-batch")
    key = F.when(F.col("id") <= CLEAN, F.col("id"))
    spark.range(1, CLEAN + NO_KEY + 1).select(
        key.alias("c_custkey"), F.format_string("name %d", "id").alias("c_name"), (F.col("id") % 25).cast("int").alias("c_nationkey"),
        (F.col("id") * 0.5).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment"),
    ).write.parquet(f"{folder}/customer.parquet")
    rows = customer_source(spark, folder, "postgres").withColumn("updated_at", F.lit("2024-01-05 00:00:00").cast("timestamp"))
    good = as_log(encode_events(rows, "postgres", "customer", event_time=F.col("updated_at"), key=F.col("id")))
    broken = spark.createDataFrame([(None, b"{no json", "canonical.customer"), (None, None, "canonical.customer")], "key binary, value binary, topic string")
    bad = broken.select("key", "value", "topic", F.lit(0).alias("partition"), F.lit(7).cast("long").alias("offset"), F.current_timestamp().alias("timestamp"))
    good.unionByName(bad).coalesce(1).write.partitionBy("topic").parquet(f"{folder}/log")
    return f"{folder}/log"


def cached(spark) -> int:
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def staged(spark, stream) -> list[str]:
    root = stream.folder("staged")
    return [b for q in child_names(spark, root) for r in child_names(spark, f"{root}/{q}") for b in child_names(spark, f"{root}/{q}/{r}")]


@pytest.mark.parametrize("sinks", [["canonical"], ["canonical", "warehouse"], ["raw", "canonical", "warehouse"]])
def test_a_batch_lies_in_files_and_not_in_a_cache(spark, sinks):
    stream, seen, before = EntityStream(spark, CUSTOMER, new_folder(spark, "staged-test"), ingest_date=INGEST_DATE), [], cached(spark)
    write = stream.write_canonical

    def watched(batch, batch_id, day):
        seen.append((cached(spark) - before, staged(spark, stream)))
        return write(batch, batch_id, day)

    stream.write_canonical = watched
    query = stream.start(file_log_stream(spark, customer_log(spark), ["customer"]), sinks, {"availableNow": True})
    query.awaitTermination()
    assert seen == [(0, ["_batch_id=0"])]
    assert staged(spark, stream) == []
    counts = {r["sink"]: r["n_rows"] for r in stream.read_counts().collect()}
    want = {"input": CLEAN + NO_KEY + BROKEN, "canonical": CLEAN, "quarantine": NO_KEY}
    want |= {"warehouse": CLEAN + NO_KEY} if "warehouse" in sinks else {}
    want |= {"raw": CLEAN + NO_KEY, "dead_letters": BROKEN} if "raw" in sinks else {}
    assert counts == want
    rows = stream.read_canonical()
    assert sorted(r["customer_id"] for r in rows.collect()) == list(range(1, CLEAN + 1))
    assert rows.filter("name = concat('NAME ', customer_id) AND balance = customer_id * 0.5 AND _source = 'postgres'").count() == CLEAN
    assert stream.golden.quarantine().count() == NO_KEY
    if "raw" in sinks:
        raw = stream.read_raw()
        assert raw.count() == CLEAN + NO_KEY == raw.select("event_id").filter("length(event_id) = 64").count()
        assert raw.filter("payload LIKE '%name 7\"%'").count() == 1
        dead = {(r["value"] and bytes(r["value"]), r["reason"], r["topic"]) for r in stream.read_dead_letters().collect()}
        assert dead == {(b"{no json", "malformed", "canonical.customer"), (None, "empty", "canonical.customer")}


def test_a_failed_batch_leaves_no_files_behind(spark):
    stream = EntityStream(spark, CUSTOMER, new_folder(spark, "staged-test"), ingest_date=INGEST_DATE)
    stream.write_canonical = lambda batch, batch_id, day: 1 / 0
    query = stream.start(file_log_stream(spark, customer_log(spark), ["customer"]), ["canonical"], {"availableNow": True})
    with pytest.raises(Exception, match="division"):
        query.awaitTermination()
    assert staged(spark, stream) == []


def test_of_equal_events_the_first_in_the_log_stays(spark):
    """The larger file of the log is read first; what is staged of it is the smaller one."""
    folder, n = new_folder(spark, "own-ties"), 30
    for name, unused in (("long" * 200, ""), ("kept", "unused" * 2_000)):
        rows = spark.range(1, n + 1).select(
            "id", F.concat(F.lit(name), F.sha2(F.col("id").cast("string"), 256)).alias("name"), F.lit(None).cast("timestamp").alias("updated_at"),
            F.concat(F.lit(unused), F.sha2(F.lit(name), 256)).alias("remark"))
        events = encode_events(rows, "postgres", "customer", event_time=F.col("updated_at"), key=F.col("id"))
        as_log(events).coalesce(1).write.mode("append").option("compression", "none").partitionBy("topic").parquet(f"{folder}/log")
    stream = EntityStream(spark, CUSTOMER, new_folder(spark, "staged-test"), ingest_date=INGEST_DATE)
    stream.start(file_log_stream(spark, f"{folder}/log", ["customer"]), ["canonical"], {"availableNow": True}).awaitTermination()
    rows = stream.read_canonical()
    assert [r[0] for r in rows.select(F.substring("name", 1, 4)).distinct().collect()] == ["KEPT"] and rows.count() == n
    assert "_place" not in rows.columns
