"""Row-by-row comparison of two reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    tolerance: Mapping[str, float] | None = None,
) -> DataFrame:
    """One row per key of either report, the differences of its values, and ``match``.

    ``diff_<value>`` is left minus right, null where a side lacks the key. ``match`` is
    true where each side has the key exactly once and all values are equal. A value named
    in ``tolerance`` may differ by that much, relative to the larger of the two; that is
    meant for plain sums of doubles only.

    This is the full outer join on the keys, null keys being equal, written as a union
    and one grouping: it shuffles once without a sort, and a key that occurs often on
    both sides gives one row instead of all its pairs.
    """
    tagged = [
        side.select(
            *keys,
            *(
                (F.col(v) if name == which else F.lit(None)).alias(f"{name}_{v}")
                for name in ("left", "right")
                for v in values
            ),
            *(F.lit(int(name == which)).alias(f"_{name}") for name in ("left", "right")),
        )
        for which, side in (("left", left), ("right", right))
    ]
    sides = (
        tagged[0]
        .unionByName(tagged[1])
        .groupBy(*keys)
        .agg(
            *(
                F.max(f"{name}_{v}").alias(f"{name}_{v}")
                for name in ("left", "right")
                for v in values
            ),
            F.sum("_left").alias("_left"),
            F.sum("_right").alias("_right"),
        )
    )
    agree = (F.col("_left") == 1) & (F.col("_right") == 1)
    for v in values:
        a, b = F.col(f"left_{v}"), F.col(f"right_{v}")
        equal = a.eqNullSafe(b)
        if v in (tolerance or {}):
            bound = F.greatest(F.abs(a), F.abs(b)) * F.lit(float(tolerance[v]))
            equal |= F.coalesce(F.abs(a - b) <= bound, F.lit(False))
        agree &= equal
    return sides.select(
        *keys,
        *(f"{name}_{v}" for v in values for name in ("left", "right")),
        *((F.col(f"left_{v}") - F.col(f"right_{v}")).alias(f"diff_{v}") for v in values),
        agree.alias("match"),
    )
