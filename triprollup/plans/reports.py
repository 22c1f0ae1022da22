"""The report from the raw table, the same from the rollup, and their comparison."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from triprollup.functions.numbers import Decimals, decimals_of, sum_sql
from triprollup.operators.reconcile import reconcile
from triprollup.schemas import COUNT_COLUMN, GROUP_KEYS

RAW_VIEW, ROLLUP_VIEW = "trips_raw", "trips_rollup"
REPORT_VALUES = ("n_trips", "sum_total_amount")
PLAIN_SUM_TOLERANCE = 1e-9
TIMING_SCHEMA = (
    "round int, report string, started_at timestamp, ended_at timestamp, "
    "seconds double, seconds_saved double, n_rows bigint"
)


ORDER = "order by vendor_id, payment_type"


def raw_report_sql(
    view: str = RAW_VIEW, decimals: Decimals = None, ordered: bool = True
) -> str:
    """Trips and takings by vendor and payment type, from single trips."""
    return f"""
        select vendor_id, payment_type, count(*) as n_trips,
               {sum_sql("total_amount", decimals_of(decimals, "total_amount"))} as sum_total_amount
        from {view}
        group by vendor_id, payment_type
        {ORDER if ordered else ""}"""


def rollup_report_sql(
    view: str = ROLLUP_VIEW, decimals: Decimals = None, ordered: bool = True
) -> str:
    """The same report from partial aggregates."""
    return f"""
        select vendor_id, payment_type, sum({COUNT_COLUMN}) as n_trips,
               {sum_sql("sum_total_amount", decimals_of(decimals, "total_amount"))} as sum_total_amount
        from {view}
        group by vendor_id, payment_type
        {ORDER if ordered else ""}"""


def takings_report_sql(view: str = RAW_VIEW, decimals: Decimals = None) -> str:
    """The raw report without the count and without an order."""
    return f"""
        select vendor_id, payment_type,
               {sum_sql("total_amount", decimals_of(decimals, "total_amount"))} as sum_total_amount
        from {view}
        group by vendor_id, payment_type"""


def register(df: DataFrame, view: str) -> str:
    """Make a frame known to SQL by name."""
    df.createOrReplaceTempView(view)
    return view


def refresh(spark: SparkSession, view: str) -> None:
    """Let a view see the files added to its directory since it was opened."""
    spark.catalog.refreshTable(view)


def report_raw(
    trips: DataFrame, decimals: Decimals = None, ordered: bool = True
) -> DataFrame:
    view = register(trips, RAW_VIEW)
    return trips.sparkSession.sql(raw_report_sql(view, decimals, ordered))


def report_rollup(
    rollup: DataFrame, decimals: Decimals = None, ordered: bool = True
) -> DataFrame:
    view = register(rollup, ROLLUP_VIEW)
    return rollup.sparkSession.sql(rollup_report_sql(view, decimals, ordered))


def report_takings(trips: DataFrame, decimals: Decimals = None) -> DataFrame:
    view = register(trips, RAW_VIEW)
    return trips.sparkSession.sql(takings_report_sql(view, decimals))


def reconcile_reports(
    trips: DataFrame,
    rollup: DataFrame,
    decimals: Decimals = None,
    tolerance: float | None = None,
) -> DataFrame:
    """Compare the two reports.

    Counts and exact sums must agree to the last digit. Plain double sums depend on the
    order of the rows, so they may differ by a part in 10^9 unless a ``tolerance`` is given.
    """
    plain = decimals_of(decimals, "total_amount") is None
    if tolerance is None:
        tolerance = PLAIN_SUM_TOLERANCE if plain else 0.0
    return reconcile(
        report_raw(trips, decimals, ordered=False),
        report_rollup(rollup, decimals, ordered=False),
        GROUP_KEYS,
        REPORT_VALUES,
        {"sum_total_amount": tolerance},
    )


def print_report(report: DataFrame) -> None:
    """Print a report row by row, fetching one partition of it at a time."""
    for row in report.toLocalIterator():
        print(*row, sep="\t")


def _run(report: Callable[[], DataFrame]) -> tuple[datetime, datetime, float, int]:
    started, clock = datetime.now(timezone.utc), time.perf_counter()
    seen = Observation()
    watched = report().observe(seen, F.count(F.lit(1)).alias("n_rows"))
    watched.write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - clock
    return started, datetime.now(timezone.utc), seconds, seen.get["n_rows"]


def timed_reports(
    trips: DataFrame | Callable[[], DataFrame],
    rollup: DataFrame | Callable[[], DataFrame],
    rounds: int = 1,
    decimals: Decimals = None,
) -> DataFrame:
    """Run both reports ``rounds`` times and tell how long each took, and its rows.

    A table given as a function is opened by it in each round, within the time taken, as are
    the refresh of its view and the planning. The report that goes first changes from round to
    round. ``seconds_saved`` is the time of the raw report in that round less that of the
    row's report. The rows of the reports are computed in full but not fetched.
    """
    opened = {"raw": (trips, RAW_VIEW, report_raw), "rollup": (rollup, ROLLUP_VIEW, report_rollup)}

    def build(label: str) -> DataFrame:
        given, view, report = opened[label]
        df = given() if callable(given) else given
        refresh(df.sparkSession, register(df, view))
        return report(df, decimals)

    rows = []
    for number in range(1, rounds + 1):
        order = list(opened) if number % 2 else list(reversed(opened))
        times = {label: _run(lambda label=label: build(label)) for label in order}
        for label in opened:
            started, ended, seconds, n_rows = times[label]
            saved = times["raw"][2] - seconds
            rows.append((number, label, started, ended, seconds, saved, n_rows))
    return SparkSession.active().createDataFrame(rows, TIMING_SCHEMA)
