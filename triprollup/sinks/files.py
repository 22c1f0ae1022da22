"""Listing and removal of directories, on any file system that Spark reads."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def children(spark: SparkSession, path: str) -> Iterator[tuple[str, int]]:
    """Name and time of change (ms) of all that is in a directory; nothing if it is not there."""
    system, where = _hadoop(spark, path)
    if system.exists(where):
        for status in system.listStatus(where):
            yield status.getPath().getName(), status.getModificationTime()


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files in a directory and below it."""
    system, where = _hadoop(spark, path)
    return system.getContentSummary(where).getLength()


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a directory with all it holds; whether there was one."""
    system, where = _hadoop(spark, path)
    return system.delete(where, True)


def make_directory(spark: SparkSession, path: str) -> None:
    """Make an empty directory, which others see at once."""
    system, where = _hadoop(spark, path)
    system.mkdirs(where)
