"""Messages by their offsets: bounded reads of ranges, and the gaps and repeats in them.

Messages carry the partition of their topic and their offset in it, as those read from Kafka do.
A range has a first offset and an end, which is not part of it, for each partition.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triprollup.sources.messages import kafka_options

TOPIC_PARTITION, OFFSET = "partition", "offset"
#: What stands for the ends of a partition in offset options.
LATEST_OFFSET, EARLIEST_OFFSET = -1, -2
#: Offsets whose neighbours are compared by one task, at most.
BUCKET = 65_536

Ranges = Mapping[int, tuple[int, int]]


def checked(ranges: Ranges) -> dict[int, tuple[int, int]]:
    for partition, (first, end) in ranges.items():
        if partition < 0 or not 0 <= first <= end:
            raise ValueError(f"no range of offsets: partition {partition} from {first} to {end}")
    return dict(sorted(ranges.items()))


def in_ranges(ranges: Ranges) -> Column:
    """Whether a message is in its partition's range; a scan prunes by it what it can."""
    found = F.lit(False)
    for partition, (first, end) in checked(ranges).items():
        within = (F.col(OFFSET) >= first) & (F.col(OFFSET) < end)
        found |= (F.col(TOPIC_PARTITION) == partition) & within
    return found


def offset_range_read(messages: DataFrame, ranges: Ranges) -> DataFrame:
    """The messages of these ranges; partitions that are not named give none."""
    return messages.filter(in_ranges(ranges))


def kafka_range_options(servers: str, topic: str, ranges: Ranges, **options: str) -> dict[str, str]:
    """The same ranges for a bounded read from Kafka: only these partitions are assigned."""
    of = checked(ranges)
    starts, ends = ({str(p): bounds[i] for p, bounds in of.items()} for i in (0, 1))
    merged = kafka_options(servers, topic, **options)
    del merged["subscribe"]
    return {
        **merged,
        "assign": json.dumps({topic: list(of)}),
        "startingOffsets": json.dumps({topic: starts}),
        "endingOffsets": json.dumps({topic: ends}),
    }


def offset_faults(messages: DataFrame, ranges: Ranges) -> DataFrame:
    """What is wrong with a read: partition, fault, first_offset, last_offset and n_messages.

    A `gap` is a stretch of offsets in a range that no message has, as long as it can be, and
    n_messages are those missing. A `repeat` is an offset that several messages have, and
    n_messages are those too many. A range without any message is one gap; an empty one is none.
    Neighbours are compared within buckets of offsets and then between them, so that no task
    has a whole partition. (A topic whose log is compacted has gaps by design.)
    """
    spark = messages.sparkSession
    of = checked(ranges)
    counted = (
        offset_range_read(messages, of)
        .groupBy(TOPIC_PARTITION, OFFSET)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", F.floor(F.col(OFFSET) / BUCKET))
    )
    repeats = counted.filter("n > 1").select(
        TOPIC_PARTITION,
        F.lit("repeat").alias("fault"),
        F.col(OFFSET).alias("first_offset"),
        F.col(OFFSET).alias("last_offset"),
        (F.col("n") - 1).alias("n_messages"),
    )

    def gaps(rows: DataFrame, low: Column, high: Column) -> DataFrame:
        """From behind `low` up to before `high`, where there is anything in between."""
        found = rows.select(
            TOPIC_PARTITION,
            F.lit("gap").alias("fault"),
            (low + 1).alias("first_offset"),
            (high - 1).alias("last_offset"),
            (high - low - 1).alias("n_messages"),
        )
        return found.filter("n_messages > 0")

    following = F.lead(OFFSET).over(Window.partitionBy(TOPIC_PARTITION, "bucket").orderBy(OFFSET))
    inside = gaps(counted.withColumn("next", following), F.col(OFFSET), F.col("next"))
    bounds = spark.createDataFrame(
        [(p, first - 1, end) for p, (first, end) in of.items()],
        f"{TOPIC_PARTITION} int, low bigint, high bigint",
    )
    edges = counted.groupBy(TOPIC_PARTITION, "bucket").agg(
        F.min(OFFSET).alias("low"), F.max(OFFSET).alias("high")
    )
    # Buckets in order, between what stands before and behind the range.
    ends = bounds.select(TOPIC_PARTITION, F.lit(None).cast("bigint").alias("bucket"), F.col("low").alias("low"), F.col("low").alias("high"))
    ends = ends.union(bounds.select(TOPIC_PARTITION, F.lit(None), F.col("high"), F.col("high")))
    order = Window.partitionBy(TOPIC_PARTITION).orderBy("low")
    between = edges.unionByName(ends).withColumn("next", F.lead("low").over(order))
    return repeats.unionByName(inside).unionByName(gaps(between, F.col("high"), F.col("next")))
