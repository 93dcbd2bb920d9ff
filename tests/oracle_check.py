"""Compare registered queries with their SQL on DuckDB: names, row counts and values."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, decimal.Decimal):
        value = int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir, query, sql):
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    got = table_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want = table_of([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    wrong = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf = sys.argv[1]
    names = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = duck(sf), oracle_sql()
    for name, query in queries().items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            if name in sqls:
                result = compare(spark, con, sf, query, sqls[name])
            else:
                result = f"rows only: {query(spark, sf).count()}"
        except Exception as exc:
            result = "ERROR " + str(exc)[:1500]
        print(f"{name:32s} {time.time() - start:6.1f}s {'ok' if result is None else result}", flush=True)
