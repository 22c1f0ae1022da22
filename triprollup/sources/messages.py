"""Streams and bounded reads of messages.

A message is a row with a ``value``, and a ``key`` where the source has keys. Reading
from Kafka needs the public ``spark-sql-kafka-0-10`` package on the class path; files
of lines are the stand-in that needs nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

LATEST, EARLIEST = "latest", "earliest"


def kafka_options(servers: str, topic: str, **options: str) -> dict[str, str]:
    """Options shared by the Kafka readers: brokers and one subscribed topic.

    There is no consumer group and nothing is committed to the brokers: how far a
    stream has come is kept in its checkpoint.
    """
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, **options}


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = LATEST,
    **options: str,
) -> DataFrame:
    """An unbounded read; ``starting_offsets`` counts only until a checkpoint exists.

    ``maxOffsetsPerTrigger`` bounds a micro-batch when a backlog has built up;
    ``minPartitions`` splits topic partitions that hold more than their share of it.
    """
    merged = kafka_options(servers, topic, startingOffsets=starting_offsets, **options)
    return spark.readStream.format("kafka").options(**merged).load()


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = EARLIEST,
    ending_offsets: str = LATEST,
    **options: str,
) -> DataFrame:
    """A bounded read of what a topic holds."""
    merged = kafka_options(
        servers,
        topic,
        startingOffsets=starting_offsets,
        endingOffsets=ending_offsets,
        **options,
    )
    return spark.read.format("kafka").options(**merged).load()


def _with_limits(reader: DataStreamReader, limits: dict[str, int]) -> DataStreamReader:
    for name, limit in limits.items():
        reader = reader.option(name, limit)
    return reader


def line_stream(spark: SparkSession, path: str, **limits: int) -> DataFrame:
    """An unbounded read of text files, nested directories included.

    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bound a micro-batch.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", True)
    return _with_limits(reader, limits).load(path)


def line_messages(spark: SparkSession, path: str) -> DataFrame:
    """A bounded read of text files."""
    return spark.read.option("recursiveFileLookup", True).text(path)


def project_value(messages: DataFrame) -> DataFrame:
    """The value of every message as text."""
    return messages.select(F.col("value").cast("string").alias("value"))


def project_key_value(messages: DataFrame) -> DataFrame:
    """Key and value of every message as text."""
    return messages.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def count_messages(messages: DataFrame) -> DataFrame:
    """How many messages a bounded read holds, as one row."""
    return messages.agg(F.count(F.lit(1)).alias("n_messages"))
