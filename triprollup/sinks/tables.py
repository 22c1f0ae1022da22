"""Raw and rollup tables.

Both are Parquet directories partitioned by ``batch_ms``. A batch owns its partition:
writing it again replaces it, so a replayed batch lands once.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triprollup.functions.time import partition_value
from triprollup.operators.latest import merge_latest
from triprollup.schemas import PARTITION, ROLLUP_KEYS, ROLLUP_TABLE_SCHEMA, STAMP
from triprollup.sources.scratch import scratch_path
from triprollup.sources.tables import RUN, history_batches, history_list, history_rows


def batch_path(path: str, batch_ms: int) -> str:
    """The directory of one batch."""
    return f"{path.rstrip('/')}/{PARTITION}={batch_ms}"


def write_batch(df: DataFrame, path: str, batch_ms: int) -> None:
    """Write the rows of one batch as its partition, replacing an earlier attempt.

    The partition is named by the caller, so the rows need no sort by partition and no
    staging directory.
    """
    df.write.mode("overwrite").parquet(batch_path(path, batch_ms))


def append_trips(df: DataFrame, path: str) -> None:
    """Plain append, with no protection against writing the same rows twice."""
    df.write.mode("append").parquet(path)


def write_partitions(df: DataFrame, path: str, partition: str = PARTITION) -> None:
    """Replace every partition the rows belong to and leave the others alone.

    Rows are brought together by partition first, so that a partition is not scattered
    over as many files as there are tasks; adaptive execution splits a partition that
    is too large for one task and joins small ones.
    """
    (
        df.hint("rebalance", F.col(partition))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def append_stamped(df: DataFrame, path: str) -> None:
    """Load stamped trips of many batches at once, such as a backfill."""
    write_partitions(df.withColumn(PARTITION, partition_value(STAMP)), path)


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def upsert_rollup(
    incoming: DataFrame,
    path: str,
    keys: Sequence[str] = ROLLUP_KEYS,
    partition: str = PARTITION,
) -> None:
    """Append to a keyed table: a row replaces the stored one with the same key.

    Only the partitions that ``incoming`` touches are read and written again. They are
    staged and swapped in at the end, so a failed job leaves the table as it was; a
    driver lost in the middle of the swap can leave a partition missing, which a second
    run of the load that wrote it, or a rollup of the raw table, brings back.
    """
    spark = incoming.sparkSession
    stored = _stored(spark, path, incoming.schema)
    if stored is None:
        write_partitions(incoming, path, partition)
        return
    # Used three times below and possibly costly to compute: it is written out once.
    staging = scratch_path(spark, "incoming")
    incoming.write.parquet(staging)
    staged = spark.read.schema(incoming.schema).parquet(staging)
    span = staged.agg(F.min(partition).alias("low"), F.max(partition).alias("high")).first()
    if span["low"] is None:
        return
    # The span prunes partitions while planning, the semi join then picks the exact ones.
    near = stored.filter(F.col(partition).between(span["low"], span["high"]))
    touched = staged.select(partition).distinct()
    affected = near.join(touched, partition, "left_semi").select(*incoming.columns)
    write_partitions(merge_latest(affected, staged, [partition, *keys]), path, partition)


def overwrite_table(df: DataFrame, name: str, path: str) -> None:
    """Replace a named table by the rows."""
    df.write.mode("overwrite").option("path", path).format("parquet").saveAsTable(name)


def define_namespace(spark: SparkSession, name: str, path: str) -> None:
    """Create a namespace for named tables, if it is not there."""
    spark.sql(f"create database if not exists {name} location '{path}'")


def define_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType = ROLLUP_TABLE_SCHEMA,
    partition: str = PARTITION,
) -> None:
    """Create a named table over a directory; an older definition is dropped.

    The data of a dropped definition stays in its directory. Parquet tables know no
    primary key; :func:`upsert_rollup` keeps the key unique.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"drop table if exists {name}")
    spark.sql(
        f"create table {name} ({columns}) using parquet "
        f"partitioned by (`{partition}`) location '{path}'"
    )


def discover_partitions(spark: SparkSession, name: str) -> None:
    """Make partitions written to the directory of a named table known to it."""
    spark.catalog.recoverPartitions(name)


def add_batch(spark: SparkSession, name: str, batch_ms: int) -> None:
    """Make one batch known to a named table, without a listing of its directory."""
    spark.sql(f"alter table {name} add if not exists partition ({PARTITION}={batch_ms})")


def compact(live: DataFrame, history: str, day: str, join_files: bool = False) -> None:
    """Copy those batches of a day that a history lacks to it.

    ``live`` is a raw or rollup table and ``day`` a date in UTC such as ``2026-01-31``. Only
    that day is read. A batch is never taken out of a history, nor copied again, so a run may
    be repeated, also once batches were removed from the live table or after a late replay.
    :func:`triprollup.sources.tables.with_history` reads both tables as one.

    Rows are written first and count only once their batches are listed, which a single file
    does; a run that was cut off before that leaves files that nothing reads.

    Nothing is shuffled: a scan task packs many small files and writes one. For tiny files,
    as a rollup has, ``join_files`` joins what the tasks give as well, by a shuffle.
    """
    spark = live.sparkSession
    start = datetime.fromisoformat(day).replace(tzinfo=timezone.utc)
    first, last = (int(t.timestamp() * 1000) for t in (start, start + timedelta(days=1)))
    known = history_batches(spark, history)
    rows = live.filter((F.col(PARTITION) >= first) & (F.col(PARTITION) < last))
    rows = rows.join(known.filter(F.col(PARTITION).between(first, last - 1)), PARTITION, "left_anti")
    if join_files:
        rows = rows.hint("rebalance")
    run = uuid4().hex
    path = f"{history_rows(history)}/{RUN}={run}"
    rows.select(*live.columns).write.parquet(path)
    copied = spark.read.schema(live.schema).parquet(path).select(PARTITION).distinct()
    copied.withColumn(RUN, F.lit(run)).coalesce(1).write.mode("append").parquet(history_list(history))
