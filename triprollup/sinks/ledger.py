"""The batches that have landed, of any number of ingests into the same tables.

    table/ingest=<query id>/batch_id=<number>/batch_ms=<stamp>/..   rows of a batch
    ledger/ingest=<query id>/batch_id=<number>/..                   its entry, one row

The id of a streaming query stays with its checkpoint, and its batches are numbered, so both
together name a batch for good: a replay finds the entry and writes nothing, or finds none and
replaces what was written. Ingests never share a directory, however equal their stamps are.
The entry is written after all tables have the batch, and readers take batches that have one.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from triprollup.schemas import PARTITION
from triprollup.sinks.commits import stored_or_none

INGEST, BATCH_ID = "ingest", "batch_id"
ENTRY = f"{PARTITION} bigint, n_rows bigint, n_refused bigint, landed_at timestamp"
BATCH_NAME = f"{INGEST} string, {BATCH_ID} bigint"


def ingest_path(path: str, ingest: str, batch_id: int) -> str:
    """The directory of one batch of one ingest."""
    return f"{path.rstrip('/')}/{INGEST}={ingest}/{BATCH_ID}={batch_id}"


def is_landed(spark: SparkSession, ledger: str, ingest: str, batch_id: int) -> bool:
    """Whether the ledger has an entry for a batch; only that entry is looked for."""
    entry = stored_or_none(spark, ingest_path(ledger, ingest, batch_id), ENTRY)
    return entry is not None and not entry.isEmpty()


def record_batch(
    spark: SparkSession,
    ledger: str,
    ingest: str,
    batch_id: int,
    batch_ms: int,
    n_rows: int,
    n_refused: int,
) -> None:
    """Enter a batch that all tables have."""
    row = (batch_ms, n_rows, n_refused, datetime.now(timezone.utc))
    entry = spark.createDataFrame([row], ENTRY).coalesce(1)
    entry.write.mode("overwrite").parquet(ingest_path(ledger, ingest, batch_id))


def landed_batches(spark: SparkSession, ledger: str) -> DataFrame:
    """All entries of a ledger: ingest, batch_id, stamp, rows taken and refused, and when."""
    whole = f"{BATCH_NAME}, {ENTRY}"
    found = stored_or_none(spark, ledger, whole)
    names = [f.name for f in T.StructType.fromDDL(whole).fields]
    return spark.createDataFrame([], whole) if found is None else found.select(*names)


def landed_table(
    spark: SparkSession, path: str, ledger: str, schema: T.StructType
) -> DataFrame:
    """A raw, rollup or reject table, of the batches that have landed, with ingest and batch_id.

    Ledger and table meet on partition columns alone, so that batches without an entry are not
    opened where Spark prunes by the smaller side.
    """
    named = T.StructType([*schema.fields, *T.StructType.fromDDL(BATCH_NAME).fields])
    rows = stored_or_none(spark, path, named)
    if rows is None:
        return spark.createDataFrame([], named)
    landed = landed_batches(spark, ledger).select(INGEST, BATCH_ID)
    return rows.join(landed, [INGEST, BATCH_ID], "left_semi").select(*named.fieldNames())
