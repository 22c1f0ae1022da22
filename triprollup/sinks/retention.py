"""Removal of live batches that a history holds, while no report reads them.

A reader leaves a mark before it lists the live table, a remover before it looks for readers.
Each looks for the other's mark after it has left its own, so that one of them always sees the
other: the reader then waits, or the remover gives up. Marks are empty directories that name
the time until which they count; one that a lost process left behind is passed over after it.

    history/marks/reading-<until, ms>-<id>
    history/marks/removing-<until, ms>-<id>
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triprollup.schemas import PARTITION
from triprollup.sinks.commits import stored_or_none
from triprollup.sinks.files import children, make_directory, remove
from triprollup.sources.tables import HISTORY_LIST, history_list

READING, REMOVING = "reading", "removing"
#: How long a mark counts, in seconds, unless it is taken away.
READ_SECONDS, REMOVE_SECONDS = 3_600.0, 600.0


def _marks(history: str) -> str:
    return f"{history.rstrip('/')}/marks"


def _is_marked(spark: SparkSession, history: str, kind: str) -> bool:
    now = time.time() * 1000
    names = (name.split("-") for name, _ in children(spark, _marks(history)))
    return any(found == kind and int(until) > now for found, until, _ in names)


@contextmanager
def _mark(spark: SparkSession, history: str, kind: str, seconds: float) -> Iterator[None]:
    name = f"{kind}-{int((time.time() + seconds) * 1000)}-{uuid4().hex}"
    make_directory(spark, f"{_marks(history)}/{name}")
    try:
        yield
    finally:
        remove(spark, f"{_marks(history)}/{name}")


@contextmanager
def reading(
    spark: SparkSession, history: str, seconds: float = READ_SECONDS, wait: float = REMOVE_SECONDS
) -> Iterator[None]:
    """While this is open, no live batch is removed. Open tables and end reports within it.

    Waits for a removal that has begun, up to `wait` seconds. A report that takes longer than
    `seconds` is no longer protected.
    """
    give_up = time.time() + wait
    while True:
        with _mark(spark, history, READING, seconds):
            if not _is_marked(spark, history, REMOVING):
                yield
                return
        if time.time() > give_up:
            raise TimeoutError(f"batches of {history} are being removed for over {wait} s")
        time.sleep(min(1.0, wait / 10))


def copied_batches(spark: SparkSession, history: str, retention_seconds: float) -> DataFrame:
    """Batches that a history has listed for so long."""
    listed = stored_or_none(spark, history_list(history), HISTORY_LIST)
    if listed is None:
        return spark.createDataFrame([], f"{PARTITION} bigint")
    before = F.lit(int((time.time() - retention_seconds) * 1000))
    listed_at = F.unix_millis(F.col("_metadata.file_modification_time"))
    return listed.filter(listed_at <= before).select(PARTITION).distinct()


def remove_compacted(
    spark: SparkSession, live: str, history: str, retention_seconds: float = 86_400
) -> list[int]:
    """Remove those batches of a live table that its history lists; tells which.

    Only the list decides: rows that a compaction copied before it was cut off are not listed,
    so their batches stay. While any report is reading, nothing is removed, and another run does
    it later. A run that is cut off has removed some batches; readers take all of them from the
    history. A batch that is replayed after its removal comes back to the live table, where
    readers pass over it, and is removed by the next run.
    """
    with _mark(spark, history, REMOVING, REMOVE_SECONDS):
        if _is_marked(spark, history, READING):
            return []
        prefix = f"{PARTITION}="
        there = [(n.removeprefix(prefix),) for n, _ in children(spark, live) if n.startswith(prefix)]
        held = spark.createDataFrame([(int(n),) for (n,) in there if n.lstrip("-").isdigit()], f"{PARTITION} bigint")
        copied = copied_batches(spark, history, retention_seconds)
        found = [r[0] for r in held.join(copied, PARTITION, "left_semi").orderBy(PARTITION).collect()]
        # Marks count for a time only: what is not done by then is left for the next run.
        until, removed = time.time() + REMOVE_SECONDS / 2, []
        for batch in found:
            if time.time() > until:
                break
            remove(spark, f"{live.rstrip('/')}/{prefix}{batch}")
            removed.append(batch)
        return removed
