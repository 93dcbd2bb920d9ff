"""Folders that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="unirec-")


def shared_root(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``; a local one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_root()


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared root; nothing is created yet."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared root and read it back: later plans start from it, and a lost
    executor does not make anyone work it out again."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; empty when it does not exist."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(p))


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, in place of the one before."""
    fs, p = _path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def write_state(spark: SparkSession, folder: str, text: str) -> None:
    """Put a small text in place of the one before.  Each write is a file of its own with the next number, so a
    write that breaks off leaves the last one; all but the two newest go.  Of two writers that start from the same text
    the later one fails."""
    numbers = sorted(int(n) for n in child_names(spark, folder) if n.isdigit())
    fs, p = _path(spark, f"{folder}/{numbers[-1] + 1 if numbers else 0:012d}")
    out = fs.create(p, False)
    out.write(bytearray((text + "\n").encode()))
    out.close()
    for n in numbers[:-1]:
        remove(spark, f"{folder}/{n:012d}")


def read_state(spark: SparkSession, folder: str) -> str | None:
    """The newest complete text; a text is complete when it has its line end."""
    for name in reversed([n for n in child_names(spark, folder) if n.isdigit()]):
        fs, p = _path(spark, f"{folder}/{name}")
        stream = fs.open(p)
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        if text.endswith("\n"):
            return text[:-1]
    return None
