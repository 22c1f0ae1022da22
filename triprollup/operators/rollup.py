"""Partial aggregates per batch, and aggregates of those."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triprollup.functions.numbers import Decimals, decimals_of, exact_sum, mean
from triprollup.schemas import COUNT_COLUMN, MEASURES, ROLLUP_KEYS, STATS


def _decimals_for(df: DataFrame, column: str, measure: str, decimals: Decimals) -> int | None:
    """Whole numbers are exact as they are."""
    fractional = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
    return decimals_of(decimals, measure) if fractional else None


def _statistic(df: DataFrame, stat: str, measure: str, decimals: Decimals) -> Column:
    digits = _decimals_for(df, measure, measure, decimals)
    if stat == "sum":
        return exact_sum(measure, digits)
    if stat == "max":
        return F.max(measure)
    if stat == "avg":
        return mean(measure, digits)
    raise ValueError(f"unknown statistic {stat!r}; known are {', '.join(STATS)}")


def batch_rollup(
    df: DataFrame,
    keys: Sequence[str] = ROLLUP_KEYS,
    measures: Sequence[str] = MEASURES,
    stats: Sequence[str] = STATS,
    count: str | None = COUNT_COLUMN,
    decimals: Decimals = None,
) -> DataFrame:
    """One row per key with ``<stat>_<measure>`` columns and the number of rows.

    Every statistic keeps a fixed-size buffer, so rows are folded on the map side and
    the shuffle carries one row per key and task, however many rows a key has. See
    :func:`triprollup.functions.numbers.sum_sql` for ``decimals``.
    """
    aggregates = [
        _statistic(df, stat, measure, decimals).alias(f"{stat}_{measure}")
        for measure in measures
        for stat in stats
    ]
    if count is not None:
        aggregates.append(F.count(F.lit(1)).alias(count))
    return df.groupBy(*keys).agg(*aggregates)


def reaggregate(
    rollup: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str] = MEASURES,
    stats: Sequence[str] = STATS,
    count: str = COUNT_COLUMN,
    decimals: Decimals = None,
) -> DataFrame:
    """A coarser rollup from a finer one: sum of sums, max of maxima, weighted average.

    The average is the sum of the sums over the sum of the counts, never an average of
    averages. It needs ``sum_<measure>`` and the count column, and measures without
    nulls, as decoded trips have them.
    """

    def coarse(stat: str, measure: str) -> Column:
        if stat == "max":
            return F.max(f"max_{measure}")
        if stat not in STATS:
            raise ValueError(f"unknown statistic {stat!r}; known are {', '.join(STATS)}")
        partial = f"sum_{measure}"
        total = exact_sum(partial, _decimals_for(rollup, partial, measure, decimals))
        if stat == "sum":
            return total
        return F.try_divide(total, F.sum(count)).cast("double")

    aggregates = [
        coarse(stat, measure).alias(f"{stat}_{measure}")
        for measure in measures
        for stat in stats
    ]
    aggregates.append(F.sum(count).alias(count))
    return rollup.groupBy(*keys).agg(*aggregates)
