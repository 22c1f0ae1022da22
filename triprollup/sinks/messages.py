"""Message sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from triprollup.operators.decode import encode_json


def write_json_to_kafka(records: DataFrame, servers: str, topic: str) -> None:
    """Every row as one JSON message on a topic; needs the Kafka package."""
    (
        encode_json(records)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
