"""Bounded reads by offset, their Kafka options, and gaps and repeats by hand."""

import json
import random

import pytest

from triprollup.sources import offsets

SCHEMA = "partition int, offset bigint, value string"


def _messages(spark, pairs):
    return spark.createDataFrame([(p, o, f"{p}:{o}") for p, o in pairs], SCHEMA).repartition(3)


def faults_by_hand(pairs, ranges):
    found = set()
    for partition, (first, end) in ranges.items():
        held = [o for p, o in pairs if p == partition and first <= o < end]
        found |= {(partition, "repeat", o, o, held.count(o) - 1) for o in held if held.count(o) > 1}
        low = first
        for o in [*sorted(set(held)), end]:
            if o > low:
                found.add((partition, "gap", low, o - 1, o - low))
            low = o + 1
    return found


def test_ranges(spark, tmp_path):
    pairs = [(p, o) for p in range(4) for o in range(50)]
    path = str(tmp_path / "messages")
    _messages(spark, pairs).write.partitionBy("partition").parquet(path)
    stored = spark.read.schema("offset bigint, value string, partition int").parquet(path)
    ranges = {2: (10, 20), 0: (45, 99), 3: (7, 7)}
    read = offsets.offset_range_read(stored, ranges)
    assert {(r["partition"], r["offset"]) for r in read.collect()} == {
        (p, o) for p, o in pairs if p in ranges and ranges[p][0] <= o < ranges[p][1]
    }
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(offset" in plan
    assert "partition#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert offsets.offset_range_read(stored, {}).count() == 0


@pytest.mark.parametrize("bucket", [65_536, 4])
def test_gaps_and_repeats(spark, monkeypatch, bucket):
    monkeypatch.setattr(offsets, "BUCKET", bucket)
    rng = random.Random(bucket)
    pairs = [(p, o) for p in range(3) for o in range(60) if rng.random() < (0.9, 0.5, 0.1)[p]]
    pairs += rng.choices(pairs, k=12)
    for ranges in (
        {0: (0, 60), 1: (5, 40), 2: (3, 90)},
        {0: (0, 0), 9: (4, 8), 1: (59, 61)},
        {},
    ):
        found = {tuple(r) for r in offsets.offset_faults(_messages(spark, pairs), ranges).collect()}
        assert found == faults_by_hand(pairs, ranges)
    whole = [(0, o) for o in range(30)]
    assert offsets.offset_faults(_messages(spark, whole), {0: (0, 30)}).count() == 0


def test_kafka_options_of_ranges():
    found = offsets.kafka_range_options("h:9092", "trips", {1: (5, 9), 0: (0, 3)}, minPartitions="8")
    assert found["kafka.bootstrap.servers"] == "h:9092" and found["minPartitions"] == "8"
    assert "subscribe" not in found
    assert json.loads(found["assign"]) == {"trips": [0, 1]}
    assert json.loads(found["startingOffsets"]) == {"trips": {"0": 0, "1": 5}}
    assert json.loads(found["endingOffsets"]) == {"trips": {"0": 3, "1": 9}}


@pytest.mark.parametrize("ranges", [{0: (5, 4)}, {-1: (0, 1)}, {0: (-2, 4)}])
def test_ranges_are_checked(ranges):
    with pytest.raises(ValueError):
        offsets.in_ranges(ranges)
