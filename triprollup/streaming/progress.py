"""What each micro-batch took, recorded as streams run, and the batches that took too long."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from triprollup.sinks.commits import stored_or_none
from triprollup.sinks.ledger import BATCH_ID, INGEST, landed_batches

RECORD = (
    f"{INGEST} string, run string, {BATCH_ID} bigint, started_at timestamp, "
    "duration_ms bigint, n_read bigint"
)


class BatchRecorder(StreamingQueryListener):
    """Appends a row to a table for each micro-batch that a stream has processed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.running: set[str] = set()
        self.failed: list[Exception] = []
        self.changed = threading.Condition()

    def _note(self, run: str, started: bool) -> None:
        with self.changed:
            (self.running.add if started else self.running.discard)(run)
            self.changed.notify_all()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._note(str(event.runId), started=True)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        told = event.progress
        took = dict(told.durationMs or {})
        if "addBatch" not in took:
            return
        try:
            row = (str(told.id), str(told.runId), told.batchId, told.timestamp, took["triggerExecution"], told.numInputRows)
            text = RECORD.replace("started_at timestamp", "started_at string")
            frame = self.spark.createDataFrame([row], text)
            frame = frame.withColumn("started_at", F.to_timestamp("started_at"))
            frame.coalesce(1).write.mode("append").parquet(self.path)
        except Exception as error:  # a listener must not raise; the recorder's user is told
            self.failed.append(error)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._note(str(event.runId), started=False)

    def wait(self, seconds: float) -> bool:
        """Until all batches of the streams that have ended are recorded; False if it took longer."""
        with self.changed:
            return self.changed.wait_for(lambda: not self.running, seconds)


@contextmanager
def recorded(spark: SparkSession, path: str, wait: float = 60) -> Iterator[BatchRecorder]:
    """Record the batches of all streams that run within; at its end they must have ended.

    Progress is told to listeners some time after a batch, so the end waits for the last one.
    """
    recorder = BatchRecorder(spark, path)
    spark.streams.addListener(recorder)
    try:
        yield recorder
        recorder.wait(wait)
    finally:
        spark.streams.removeListener(recorder)
    if recorder.failed:
        raise recorder.failed[0]


def recorded_batches(spark: SparkSession, path: str) -> DataFrame:
    """One row for each batch; of one that was processed again, the last time."""
    found = stored_or_none(spark, path, RECORD)
    if found is None:
        return spark.createDataFrame([], RECORD)
    names = [c for c in found.columns if c not in (INGEST, BATCH_ID)]
    last = F.max(F.struct("started_at", *(c for c in names if c != "started_at"))).alias("b")
    grouped = found.groupBy(INGEST, BATCH_ID).agg(last)
    return grouped.select(INGEST, BATCH_ID, *(F.col("b")[c].alias(c) for c in names))


def batch_progress(
    spark: SparkSession, path: str, ledger: str, interval_seconds: float
) -> DataFrame:
    """Batches that have landed with their rows, how long each took, and how far it fell behind.

    Rows are those of the ledger; a stream's own count has each row as often as it was read.
    `lag_ms` is what a batch took beyond the interval of its trigger, and `is_late` tells whether
    it did. A batch whose progress was not recorded has nulls there.
    """
    took = recorded_batches(spark, path).select(INGEST, BATCH_ID, "started_at", "duration_ms")
    lag = F.greatest(F.col("duration_ms") - F.lit(int(interval_seconds * 1000)), F.lit(0))
    return (
        landed_batches(spark, ledger)
        .join(took, [INGEST, BATCH_ID], "left")
        .withColumn("lag_ms", F.when(F.col("duration_ms").isNotNull(), lag))
        .withColumn("is_late", F.col("lag_ms") > 0)
    )
