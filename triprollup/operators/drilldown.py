"""Where two tables differ: by checksums of batches, then of keys, then row by row.

A checksum is the number of rows, the sum and the exclusive or of their hashes, so it does not
depend on their order and is folded on the map side. Each level reads only what differed on the
level above: tables that agree cost one pass that shuffles a row for each batch and task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triprollup.operators.reconcile import reconcile
from triprollup.sources.scratch import scratch_path

SUMS = ("n_rows", "hash_sum", "hash_xor")
SIDE, COPIES = "side", "n_copies"
#: Batches up to so many are named to the scan one by one; beyond that by their range first.
NAMED_BATCHES = 2_000


def row_hash(columns: Sequence[str]) -> Column:
    """A hash of a row that tells null from any value, and one column from the next."""
    parts = [part for c in columns for part in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(*parts)


def checksums(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of rows and order-independent checksums of all columns, by key."""
    hashed = row_hash(sorted(df.columns))
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(SUMS[0]),
        # 32 bits of each hash: the sum of 2^31 rows of a group fits into a bigint.
        F.sum(F.shiftrightunsigned(hashed, 32)).alias(SUMS[1]),
        F.bit_xor(hashed).alias(SUMS[2]),
    )


def differing(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys whose rows are not the same on both sides."""
    compared = reconcile(checksums(left, keys), checksums(right, keys), keys, SUMS)
    return compared.filter(~F.col("match")).select(*keys)


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def of_batches(df: DataFrame, batches: DataFrame, batch: str) -> DataFrame:
    """Rows of these batches; the others are pruned by the scan of a partitioned table."""
    span = batches.agg(F.count(F.lit(1)), F.min(batch), F.max(batch)).first()
    nulls = batches.filter(F.col(batch).isNull()).isEmpty()
    if span[0] <= NAMED_BATCHES:
        named = F.col(batch).isin([r[0] for r in batches.collect() if r[0] is not None])
        return df.filter(named if nulls else named | F.col(batch).isNull())
    near = F.col(batch).between(span[1], span[2])
    near = df.filter(near if nulls else near | F.col(batch).isNull())
    return near.join(batches.withColumnRenamed(batch, "_b"), F.col(batch).eqNullSafe(F.col("_b")), "left_semi")


def drill_down(
    left: DataFrame, right: DataFrame, batch: str, keys: Sequence[str]
) -> DataFrame:
    """Each row that one side has more often than the other, with `side` and `n_copies`.

    Both sides have the same columns. `side` tells which has it more often, and `n_copies` by
    how much; a changed row is one of each side. Sides that agree give no rows. Null batches and
    keys are values like others.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError("the two sides must have the same columns")
    right = right.select(*left.columns)
    batches = _stored(differing(left, right, [batch]), "batches")
    sides = [of_batches(side, batches, batch) for side in (left, right)]
    groups = _stored(differing(*sides, list(dict.fromkeys([batch, *keys]))), "groups")
    named = groups.select(*(F.col(c).alias(f"_g{i}") for i, c in enumerate(groups.columns)))
    same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(groups.columns)]
    condition = same[0]
    for one in same[1:]:
        condition &= one
    signed = [
        side.join(named, condition, "left_semi").withColumn("_n", F.lit(sign))
        for side, sign in zip(sides, (1, -1))
    ]
    counted = signed[0].unionByName(signed[1]).groupBy(*left.columns).agg(F.sum("_n").alias("_n"))
    return counted.filter("_n <> 0").select(
        *left.columns,
        F.when(F.col("_n") > 0, "left").otherwise("right").alias(SIDE),
        F.abs("_n").alias(COPIES),
    )
