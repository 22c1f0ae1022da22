"""Stored tables and files of trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triprollup.schemas import (
    PARTITION,
    RAW_TABLE_SCHEMA,
    REJECT_TABLE_SCHEMA,
    ROLLUP_TABLE_SCHEMA,
    TRIP_SCHEMA,
)

#: The column that tells which run copied a batch to a history.
RUN = "run"
HISTORY_LIST = f"{PARTITION} bigint, {RUN} string"


def parquet_table(spark: SparkSession, path: str) -> DataFrame:
    """Any Parquet directory, with the schema of its footers."""
    return spark.read.parquet(path)


def merged_schema_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet directory whose files differ in columns; missing ones read as null."""
    return spark.read.option("mergeSchema", True).parquet(path)


def raw_table(spark: SparkSession, path: str) -> DataFrame:
    """The stamped trips. The schema is known, so no footer is opened to plan."""
    return spark.read.schema(RAW_TABLE_SCHEMA).parquet(path)


def rollup_table(spark: SparkSession, path: str) -> DataFrame:
    """The stored rollup."""
    return spark.read.schema(ROLLUP_TABLE_SCHEMA).parquet(path)


def reject_table(spark: SparkSession, path: str) -> DataFrame:
    """The quarantined lines."""
    return spark.read.schema(REJECT_TABLE_SCHEMA).parquet(path)


def history_rows(history: str) -> str:
    """Where the rows of compacted batches are, a directory for each run."""
    return f"{history.rstrip('/')}/rows"


def history_list(history: str) -> str:
    """Where it is listed which run copied which batch."""
    return f"{history.rstrip('/')}/batches"


def history_batches(spark: SparkSession, history: str) -> DataFrame:
    """The batches that a history holds, and the run that counts for each.

    Should two runs at the same time have copied a batch, one of them counts.
    """
    try:
        listed = spark.read.schema(HISTORY_LIST).parquet(history_list(history))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        listed = spark.createDataFrame([], HISTORY_LIST)
    return listed.groupBy(PARTITION).agg(F.min(RUN).alias(RUN))


def with_history(live: DataFrame, history: str) -> DataFrame:
    """A table and its compacted history as one: each batch from one of the two.

    Batches that the history lists are read there, whether or not the live table still has
    them; all others are read from the live table.
    """
    spark = live.sparkSession
    batches = history_batches(spark, history)
    rest = live.join(batches, PARTITION, "left_anti").select(*live.columns)
    if batches.isEmpty():
        return rest
    schema = T.StructType([*live.schema.fields, T.StructField(RUN, T.StringType())])
    rows = spark.read.schema(schema).parquet(history_rows(history))
    old = rows.join(batches, [RUN, PARTITION], "left_semi")
    return old.select(*live.columns).unionByName(rest)


def csv_file(spark: SparkSession, path: str) -> DataFrame:
    """A trip CSV file with a header line, in the declared types.

    A field that is not of its type, or a line with too few or too many, fails the job.
    """
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    return reader.schema(TRIP_SCHEMA).csv(path)


def as_trips(df: DataFrame) -> DataFrame:
    """The 19 trip columns in order, cast to their types."""
    return df.select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in TRIP_SCHEMA.fields)
    )


def literal_trips(spark: SparkSession, rows: Sequence[Sequence]) -> DataFrame:
    """Trips given in the program."""
    return spark.createDataFrame([tuple(row) for row in rows], TRIP_SCHEMA)
