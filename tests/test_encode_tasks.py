"""Rows are dealt by their number before they are encoded, and a log has as many files as tasks encode it."""

from pyspark.sql import functions as F

from unirec.functions.shared import child_names, new_folder
from unirec.plans import derived, stream_queries
from unirec.plans.derived import CUSTOMER, encode_tasks, spread


def customers(spark, n: int) -> str:
    """A folder with a customer table of one file and one row group."""
    folder = new_folder(spark, "own-tables")
    spark.range(1, n + 1).select(
        F.col("id").alias("c_custkey"), F.format_string("name %d", "id").alias("c_name"), (F.col("id") % 25).cast("int").alias("c_nationkey"),
        (F.col("id") * 0.5).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment"),
    ).coalesce(1).write.parquet(f"{folder}/customer.parquet")
    return folder


def test_one_row_group_goes_to_many_tasks(spark):
    rows = spark.read.parquet(customers(spark, 130_000) + "/customer.parquet")
    assert encode_tasks(rows) == 6 == spread(rows).rdd.getNumPartitions()
    assert encode_tasks(rows.limit(0)) is None
    assert encode_tasks(spark.range(39_999).coalesce(1)) is None
    assert encode_tasks(spark.range(10_000_000, numPartitions=1)) == max(2 * spark.sparkContext.defaultParallelism, 20)
    assert encode_tasks(spark.range(10_000_000, numPartitions=64)) is None
    spark.conf.set("unirec.encode.tasks", "3")
    try:
        assert encode_tasks(rows) == 3
    finally:
        spark.conf.unset("unirec.encode.tasks")


def test_files_of_an_append_follow_its_rows(spark, monkeypatch):
    sf_dir = customers(spark, 300)
    assert stream_queries.log_files(spark, sf_dir, "customer", "postgres") == 2
    monkeypatch.setattr(derived, "LEAST_ROWS", 50)
    assert stream_queries.log_files(spark, sf_dir, "customer", "postgres") == 6
    folder = new_folder(spark, "own-log")
    log = stream_queries.write_log(spark, sf_dir, folder, "customer", ["postgres", "teradata"])
    files = [n for n in child_names(spark, f"{log}/topic=canonical.customer") if n.endswith(".parquet")]
    assert len(files) == 12


def test_an_append_is_a_batch(spark, monkeypatch):
    sf_dir = customers(spark, 300)
    results = []
    for least in (20_000, 50):
        monkeypatch.setattr(derived, "LEAST_ROWS", least)
        stream, _ = stream_queries.run_entity(spark, sf_dir, CUSTOMER, ["canonical"], mode="event_time")
        batches = stream.read_counts().filter("sink = 'input'").groupBy("n_rows").count().collect()
        assert [tuple(b) for b in batches] == [(300, 3)]
        results.append(sorted(map(str, stream.read_canonical().collect())))
    assert results[0] == results[1] and len(results[0]) == 300
