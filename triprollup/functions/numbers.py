"""Aggregate expressions over measures."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimals of all measures, or of each; a measure that is not named gets a plain sum.
Decimals = int | Mapping[str, int] | None

#: Doubles hold whole numbers up to here exactly.
EXACT = 2**53
#: How far a double of so many decimals can be from a whole number of units, relatively.
ULPS = 2e-15


def decimals_of(decimals: Decimals, measure: str) -> int | None:
    """The decimals of one measure."""
    return decimals.get(measure) if isinstance(decimals, Mapping) else decimals


def sum_sql(measure: str, decimals: int | None = None) -> str:
    """SQL text of the sum of a measure.

    Without ``decimals`` this is the plain ``sum``, whose last digits depend on the
    order of the rows when the measure is a double. With ``decimals`` the values are
    added up as whole multiples of ``10^-decimals`` in a bigint, so the result is the
    same for every order and every split into batches. A finite value with more decimals
    than that, and a value or sum of more than 2^53 units, fails the job: nothing is
    rounded. A group with a ``NaN`` or an infinity has the plain sum, which then does not
    depend on the order either.
    """
    if decimals is None:
        return f"sum({measure})"
    if not 0 <= decimals <= 9:
        raise ValueError(f"decimals must be between 0 and 9, not {decimals}")
    scaled = f"({measure} * 1e{decimals}D)"
    finite = f"(not isnan({measure}) and abs({measure}) < double('infinity'))"
    fits = f"abs({scaled}) <= {EXACT}D and abs({scaled} - rint({scaled})) <= abs({scaled}) * {ULPS}D"
    refused = f"raise_error(concat('{measure} is not of {decimals} decimals: ', {measure}))"
    units = f"case when {finite} then if({fits}, cast(rint({scaled}) as bigint), {refused}) end"
    total = f"try_sum({units})"
    large = f"raise_error('the sum of {measure} has more than 2^53 units')"
    exact = f"cast(cast({total} as decimal(20, 0)) * 1e-{decimals}BD as double)"
    return (
        f"case when count_if(not {finite}) > 0 then sum({measure}) "
        f"when abs({total}) > {EXACT} or ({total} is null and count({measure}) > 0) "
        f"then {large} else {exact} end"
    )


def exact_sum(measure: str, decimals: int | None = None) -> Column:
    """Column form of :func:`sum_sql`."""
    return F.expr(sum_sql(measure, decimals))


def mean(measure: str, decimals: int | None = None) -> Column:
    """Average over the non-null values, from the sum :func:`exact_sum` gives.

    Written as sum over count: next to a sum of the same measure both share one
    aggregation buffer, which ``avg`` would not.
    """
    return F.try_divide(exact_sum(measure, decimals), F.count(measure)).cast("double")
