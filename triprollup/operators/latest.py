"""Last write wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """The newest row of every key; ``newest_first`` columns are compared descending.

    Catalyst turns the rank filter into a per-task limit before the shuffle, so a key
    written very often sends one row per task.
    """
    order = [F.col(name).desc() for name in newest_first]
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def merge_latest(
    stored: DataFrame, incoming: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """``stored`` with the rows of ``incoming`` put in place of those with equal keys.

    ``incoming`` must hold a key once, as a rollup does.
    """
    columns = stored.columns
    both = stored.withColumn("_load", F.lit(0)).unionByName(
        incoming.select(*columns).withColumn("_load", F.lit(1))
    )
    return latest_by_key(both, keys, ["_load"]).select(*columns)
