"""Recorded micro-batches against the ledger."""

import pytest

from conftest import line
from triprollup.sinks.ledger import landed_batches
from triprollup.sources.messages import line_stream
from triprollup.streaming import ingest, progress


@pytest.fixture
def run(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    paths = {n: str(tmp_path / n) for n in ("raw", "rollup", "checkpoint", "ledger")}

    def start(part, *lines):
        (feed / f"{part}.txt").write_text("".join(f"{x}\n" for x in lines))
        ingest.run_ingest(line_stream(spark, str(feed), maxFilesPerTrigger=1), **paths, decimals=2)

    return start, paths["ledger"], str(tmp_path / "progress")


def test_recorded_batches_are_those_that_landed(spark, run):
    start, ledger, path = run
    with progress.recorded(spark, path) as recorder:
        for part in range(2):
            start(part, *[line()] * (part + 2))
        assert recorder.wait(60)
    start("unrecorded", line())
    found = progress.batch_progress(spark, path, ledger, 0).orderBy("landed_at").collect()
    assert [r["n_rows"] for r in found] == [2, 3, 1]
    assert all(r["duration_ms"] > 0 and r["lag_ms"] == r["duration_ms"] and r["is_late"] for r in found[:2])
    assert found[2]["duration_ms"] is None and found[2]["lag_ms"] is None
    assert found[0]["started_at"] <= found[0]["landed_at"] <= found[1]["landed_at"]
    slow = progress.batch_progress(spark, path, ledger, 3600).collect()
    assert [r["lag_ms"] for r in slow].count(0) == 2 and not any(r["is_late"] for r in slow)
    assert landed_batches(spark, ledger).count() == 3


def test_a_batch_that_fails_and_is_processed_again(spark, run, monkeypatch):
    start, ledger, path = run
    real = ingest.roll_up_batch

    def die(*_):
        raise RuntimeError("killed")

    with progress.recorded(spark, path):
        monkeypatch.setattr(ingest, "roll_up_batch", die)
        with pytest.raises(Exception, match="killed"):
            start("a", line())
        monkeypatch.setattr(ingest, "roll_up_batch", real)
        start("b", line())
    found = progress.recorded_batches(spark, path)
    assert found.count() == 2 == progress.batch_progress(spark, path, ledger, 1).filter("duration_ms > 0").count()


def test_the_same_batch_recorded_twice(spark, tmp_path):
    path = str(tmp_path / "progress")
    assert progress.recorded_batches(spark, path).count() == 0
    for run, at, took in (("x", "2016-01-01 00:00:00", 5), ("y", "2016-01-01 00:01:00", 7)):
        row = spark.sql(f"select 'q' as ingest, '{run}' as run, 1L as batch_id, timestamp'{at}' as started_at, {took}L as duration_ms, 1L as n_read")
        row.write.mode("append").parquet(path)
    assert [(r["run"], r["duration_ms"]) for r in progress.recorded_batches(spark, path).collect()] == [("y", 7)]


def test_a_recorder_that_cannot_write_says_so(spark, run, tmp_path):
    start, _, _ = run
    (tmp_path / "file").write_text("")
    with pytest.raises(Exception):
        with progress.recorded(spark, str(tmp_path / "file")):
            start("a", line())
