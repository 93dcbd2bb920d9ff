"""Streams: one result for any split of the input, errors that surface, monitoring."""

import pytest
from pyspark.sql import functions as F

from unirec.functions.shared import new_folder
from unirec.plans.derived import CUSTOMER, INGEST_DATE, customer_source, entity_log
from unirec.sources.topics import file_log_stream, kafka_stream
from unirec.streaming.backfill import publish_increment
from unirec.streaming.entity import EntityStream
from unirec.streaming.monitor import progress_table, status_table, stop_all

ALL_NOW = {"availableNow": True}


def run(spark, log, files, mode="event_time"):
    folder = new_folder(spark, "stream-test")
    stream = EntityStream(spark, CUSTOMER, folder, mode=mode, ingest_date=INGEST_DATE)
    query = stream.start(file_log_stream(spark, log, ["customer"], max_files_per_trigger=files), trigger=ALL_NOW)
    query.awaitTermination()
    return stream, query


def test_any_split_gives_one_result(spark, sf_dir):
    log = new_folder(spark, "split-test")
    entity_log(spark, sf_dir, "customer").repartition(5).write.partitionBy("topic").parquet(log)
    results = []
    for files in (1, 3, None):
        stream, query = run(spark, log, files)
        rows = stream.read_canonical()
        results.append(sorted(map(str, rows.collect())))
        assert stream.read_raw().count() == stream.read_warehouse().count() == 3 * rows.count()
        assert progress_table(spark, [query]).agg(F.sum("input_rows")).first()[0] == 3 * rows.count()
        assert not status_table(spark, [query]).first()["active"]
    assert results[0] == results[1] == results[2]


def test_stream_continues_from_its_checkpoint(spark, sf_dir):
    log = new_folder(spark, "resume-test")
    events = entity_log(spark, sf_dir, "customer")
    folder = new_folder(spark, "stream-test")
    for low, high in ((0, 80), (80, 10**9)):
        part = events.filter((F.col("key").cast("string").cast("bigint") >= low) & (F.col("key").cast("string").cast("bigint") < high))
        part.coalesce(1).write.mode("append").partitionBy("topic").parquet(log)
        stream = EntityStream(spark, CUSTOMER, folder, ingest_date=INGEST_DATE)
        stream.start(file_log_stream(spark, log, ["customer"]), trigger=ALL_NOW).awaitTermination()
    assert stream.golden.last_batch() == (0, 1)
    assert stream.read_canonical().count() == 150
    assert stream.read_raw().count() == 450


def test_sink_errors_stop_the_query(spark, sf_dir):
    log = new_folder(spark, "error-test")
    entity_log(spark, sf_dir, "customer").coalesce(1).write.partitionBy("topic").parquet(log)
    stream = EntityStream(spark, CUSTOMER, new_folder(spark, "stream-test"))
    stream.write_raw = lambda batch, batch_id, day: 1 / 0
    query = stream.start(file_log_stream(spark, log, ["customer"]), ["raw"], ALL_NOW)
    with pytest.raises(Exception, match="division"):
        query.awaitTermination()
    assert stream.start(file_log_stream(spark, log, ["customer"]), ["warehouse"], ALL_NOW).awaitTermination() is None
    stop_all(spark)
    with pytest.raises(ValueError):
        stream.start(file_log_stream(spark, log, ["customer"]), ["elsewhere"])


def test_polls_publish_each_row_once(spark, sf_dir):
    folder = new_folder(spark, "poll-test")
    rows = customer_source(spark, sf_dir, "postgres")
    counts = [publish_increment(rows, "postgres", "customer", "updated_at", f"{folder}/log", f"{folder}/marks")
              for _ in range(2)]
    assert counts == [150, 0]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_stream(spark, "localhost:9092", ["customer"])
