"""Tables that guard a primary key and change from one version to the next at once.

A table is defined once, with its columns, its key, the column it is partitioned by and, if
there is one, the column that orders its writes. An upsert copies each partition it touches,
merged with the load, into a directory of its own, and then adds one commit file that names
these copies (:mod:`triprollup.sinks.commits`). Readers take each partition from the copy that
is named last.

    path/definition            columns, key, partition, order
    path/rows/run=../part=..   copies of partitions, one directory for each upsert
    path/commits/epoch=..      a file for each version
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triprollup.sinks.commits import (
    ATTEMPTS,
    EPOCH_COLUMN,
    OtherWriter,
    add_commit,
    committed,
    current,
    latest,
    stored_or_none,
)
from triprollup.sinks.files import children, remove
from triprollup.sources.scratch import scratch_path
from triprollup.sources.tables import RUN

DEFINITION = "columns string, keys array<string>, partition string, write_order array<string>"
#: What a commit lists: the partition, and the run whose copy of it counts.
PART = "part"
LISTED = f"{PART} bigint, {RUN} string"
LOAD = "_load"


def newest_by_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key, by the `order` columns and then by the load it came with.

    Fails if a load gives a key several rows that differ and nothing tells which is the last.
    One aggregation by key does both: rows are folded before the shuffle, so that a key given
    very often costs a row for each task. Rows that are alike count as one.
    """
    rest = [c for c in rows.columns if c not in keys and c != LOAD]
    rank = [F.col(c) for c in (*order, LOAD)]
    hashed = F.xxhash64(*(F.col(c) for c in rest)) if rest else F.lit(0).cast("bigint")

    def most(*more: Column) -> Column:
        return F.max(F.struct(*(c.alias(f"r{i}") for i, c in enumerate(rank)), *more))

    # The greatest and the least hash of the newest rows: they are one if the rows are.
    found = rows.groupBy(*keys).agg(
        most(hashed.alias("h"), F.struct(*(F.col(c) for c in rest)).alias("row")).alias("_high"),
        most(F.bitwise_not(hashed).alias("h")).alias("_low"),
    )
    one = F.col("_high.h") == F.bitwise_not(F.col("_low.h"))
    given = F.concat_ws(", ", *(F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys))
    message = F.concat(F.lit("key given twice, in rows that nothing orders: "), given)
    return found.filter(F.assert_true(one, message).isNull()).select(
        *(F.col(k) if k in keys else F.col("_high.row")[k].alias(k) for k in rows.columns if k != LOAD)
    )


@dataclass(frozen=True)
class KeyedTable:
    """A keyed table at a path; made by :func:`define_keyed` or :func:`open_keyed`."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    partition: str
    order: tuple[str, ...]

    @property
    def _rows(self) -> str:
        return f"{self.path}/rows"

    @property
    def _commits(self) -> str:
        return f"{self.path}/commits"

    def listing(self) -> DataFrame:
        """Each partition that the table has, with the run whose copy of it counts."""
        return latest(committed(self.spark, self._commits, LISTED), [PART])

    def _copies(self, listing: DataFrame) -> DataFrame:
        """The rows of these copies. Their paths reach the driver, as those of any table do."""
        at = [f"{self._rows}/{RUN}={r[RUN]}/{self.partition}={r[PART]}" for r in listing.collect()]
        if not at:
            return self.spark.createDataFrame([], self.schema)
        whole = T.StructType([*self.schema.fields, T.StructField(RUN, T.StringType())])
        reader = self.spark.read.schema(whole).option("basePath", self._rows)
        return reader.parquet(*at).select(*self.schema.fieldNames())

    def rows(self, low: int | None = None, high: int | None = None) -> DataFrame:
        """The table as it is now, or its partitions from `low` to `high`."""
        listing = self.listing()
        if low is not None:
            listing = listing.filter(F.col(PART) >= low)
        if high is not None:
            listing = listing.filter(F.col(PART) <= high)
        return self._copies(listing)

    def version(self) -> int:
        """How many upserts the table has seen."""
        return current(committed(self.spark, self._commits, LISTED))[0]

    def _staged(self, incoming: DataFrame) -> DataFrame:
        """The load, written once, as it is merged again if another writer comes first."""
        if sorted(incoming.columns) != sorted(self.schema.fieldNames()):
            raise ValueError(f"a load must have the columns {', '.join(self.schema.fieldNames())}")
        staging = scratch_path(self.spark, "load")
        typed = incoming.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema))
        null = F.col(self.partition).isNull()
        checked = F.assert_true(~null, F.lit(f"a row without {self.partition}"))
        typed.filter(checked.isNull()).write.parquet(staging)
        return self.spark.read.schema(self.schema).parquet(staging)

    def _write_copies(self, merged: DataFrame, run: str) -> None:
        rows = merged.hint("rebalance", F.col(self.partition))
        rows.write.partitionBy(self.partition).parquet(f"{self._rows}/{RUN}={run}")

    def upsert(self, incoming: DataFrame) -> None:
        """Put rows in place of those with the same key, all of them or none.

        With an order, the newest row of a key stays, whether it is in the table, in the load, or
        there several times; of rows equally new the load's. Without, the load's row stays, and
        a load that has a key in several different rows is refused. A failure, and a driver that
        is lost at any moment, leaves the table as it was before or as it is afterwards. An empty
        load makes no version.
        """
        staged = self._staged(incoming)
        touched = staged.select(F.col(self.partition).cast("bigint").alias(PART)).distinct()
        if touched.isEmpty():
            return
        for _ in range(ATTEMPTS):
            known = committed(self.spark, self._commits, LISTED)
            base, listing = current(known), latest(known, [PART])
            old = self._copies(listing.join(touched, PART, "left_semi"))
            both = old.withColumn(LOAD, F.lit(0)).unionByName(staged.withColumn(LOAD, F.lit(1)))
            run = uuid4().hex
            self._write_copies(newest_by_key(both, self._identity, self.order), run)
            changed = touched.withColumn(RUN, F.lit(run))
            rest = listing.join(touched, PART, "left_anti")
            if self._commit(run, base, changed, rest):
                return
        raise OtherWriter(f"{ATTEMPTS} times another writer changed {self.path} first")

    @property
    def _identity(self) -> list[str]:
        """A key lives in one partition, so the partition is part of it."""
        return list(dict.fromkeys([self.partition, *self.keys]))

    def _commit(self, run: str, base, changed: DataFrame, rest: DataFrame) -> bool:
        return add_commit(self.spark, self._commits, LISTED, run, base, changed, [rest])

    def remove_stale(self, retention_seconds: float = 86_400) -> int:
        """Remove copies that no longer count, and how many.

        Those younger than the retention stay: a report that opened them, or an upsert that has
        not committed yet, may need them. Only names are listed.
        """
        known = committed(self.spark, self._commits, LISTED)
        live = {(r[RUN], str(r[PART])) for r in latest(known, [PART]).collect()}
        before, removed = time.time() * 1000 - retention_seconds * 1000, 0
        for run, _ in list(children(self.spark, self._rows)):
            for part, changed in list(children(self.spark, f"{self._rows}/{run}")):
                name = (run.partition("=")[2], part.partition("=")[2])
                if "=" in part and name not in live and changed < before:
                    removed += remove(self.spark, f"{self._rows}/{run}/{part}")
        epoch = current(known)[1]
        for name, changed in list(children(self.spark, self._commits)):
            old = name.startswith(f"{EPOCH_COLUMN}=") and int(name.partition("=")[2]) < epoch
            if old and changed < before:
                remove(self.spark, f"{self._commits}/{name}")
        return removed


def define_keyed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    partition: str,
    order: Sequence[str] = (),
) -> KeyedTable:
    """Define a keyed table, or open the one that is defined alike.

    The key and the columns that order writes are part of the definition, which a path keeps;
    another definition of the same path is refused. The partition column is a whole number.
    """
    for name in (*keys, partition, *order):
        if name not in schema.fieldNames():
            raise ValueError(f"there is no column {name}")
    if not keys or not isinstance(schema[partition].dataType, T.IntegralType):
        raise ValueError("a table needs a key and a partition column of whole numbers")
    row = (schema.json(), list(keys), partition, list(order))
    where = f"{path.rstrip('/')}/definition"
    if stored_or_none(spark, where, DEFINITION) is None:
        spark.createDataFrame([row], DEFINITION).coalesce(1).write.parquet(where)
    table = open_keyed(spark, path)
    if (table.schema.json(), list(table.keys), table.partition, list(table.order)) != row:
        raise ValueError(f"{path} is defined otherwise")
    return table


def open_keyed(spark: SparkSession, path: str) -> KeyedTable:
    """A keyed table that was defined before."""
    path = path.rstrip("/")
    found = stored_or_none(spark, f"{path}/definition", DEFINITION)
    if found is None:
        raise ValueError(f"no keyed table is defined at {path}")
    row = found.first()
    schema = T.StructType.fromJson(json.loads(row["columns"]))
    return KeyedTable(spark, path, schema, tuple(row["keys"]), row["partition"], tuple(row["write_order"]))
