"""Reading the corpus tables and cutting lineage with tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triprollup.sources.scratch import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """The same rows, read back from a table in the shared folder.

    A lost executor then costs the tasks in hand and not the work before them.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_of_id(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's decimal digits, on which the held-out folds depend."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def ceil_div(n: int, by: int) -> int:
    return -(-n // by)
