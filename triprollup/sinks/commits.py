"""Lists that say which written files count: one file for each commit.

A writer puts its rows where no reader looks and then adds one file here, with the version it
makes and what counts from now on. A file appears whole or not at all, so that a writer that is
lost at any moment leaves the version before or its own. Should two writers make the same
version, the file that came first counts; the other writer finds its own missing and makes the
next version from there.

Every `EPOCH` versions a file holds everything that counts, in a folder of its own, and readers
start from there.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION, WRITER, EPOCH_COLUMN = "version", "writer", "epoch"
#: Versions of an epoch.
EPOCH = 50
#: How often a writer tries again that came second.
ATTEMPTS = 5

OWN = f"{VERSION} bigint, {WRITER} string"


class OtherWriter(RuntimeError):
    """Other writers made each version that this one tried to make."""


def stored_or_none(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """A Parquet directory of this schema; None if there is nothing at the path."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def committed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows that count of the current epoch, with version, writer and epoch."""
    whole = f"{OWN}, {schema}, {EPOCH_COLUMN} bigint"
    listed = stored_or_none(spark, path, whole)
    if listed is None:
        return spark.createDataFrame([], whole)
    last = listed.agg(F.max(EPOCH_COLUMN)).first()[0]
    names = listed.columns
    rows = listed.filter(F.col(EPOCH_COLUMN) == F.lit(last)).select(
        "*", F.col("_metadata.file_modification_time").alias("_at")
    )
    first = rows.groupBy(VERSION).agg(F.min(F.struct("_at", WRITER))[WRITER].alias(WRITER))
    return rows.join(first, [VERSION, WRITER], "left_semi").select(*names)


def latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of committed rows the one of the last version for each key."""
    rest = [VERSION, *(c for c in rows.columns if c not in (*keys, VERSION))]
    newest = rows.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
    return newest.select(*keys, *(F.col("_row")[c].alias(c) for c in rest))


def current(rows: DataFrame) -> tuple[int, int]:
    """Version and epoch of a list, 0 and 0 before the first commit."""
    found = rows.agg(F.max(VERSION), F.max(EPOCH_COLUMN)).first()
    return found[0] or 0, found[1] or 0


def add_commit(
    spark: SparkSession,
    path: str,
    schema: str,
    writer: str,
    base: tuple[int, int],
    changed: DataFrame,
    unchanged: Iterable[DataFrame],
) -> bool:
    """Add the version after `base` and tell whether it counts.

    changed: what this version lists; unchanged: what else counts at `base`, to be listed again
    where an epoch begins. Both have the columns of `schema`, and may have more.
    """
    version, epoch = base[0] + 1, base[1]
    names = [f.name for f in T.StructType.fromDDL(schema).fields]
    rows = changed.select(*names)
    if version % EPOCH == 0:
        epoch += 1
        for more in unchanged:
            rows = rows.unionByName(more.select(*names))
    told = rows.select(F.lit(version).cast("bigint").alias(VERSION), F.lit(writer).alias(WRITER), *names)
    told.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/{EPOCH_COLUMN}={epoch}")
    now = committed(spark, path, schema)
    return not now.filter((F.col(VERSION) == version) & (F.col(WRITER) == writer)).isEmpty()
