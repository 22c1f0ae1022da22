"""Timestamp expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the pattern stamps are printed with, e.g. 2017-07-19 09:55:42+0000.
STAMP_PATTERN = "yyyy-MM-dd HH:mm:ssZ"


def processing_time() -> Column:
    """The current timestamp: one value per query, or per micro-batch of a stream."""
    return F.current_timestamp()


def partition_value(stamp: str | Column) -> Column:
    """Milliseconds since the epoch, the partition a stamped row lands in."""
    return F.unix_millis(F.col(stamp) if isinstance(stamp, str) else stamp)


def format_stamp(stamp: str | Column, pattern: str = STAMP_PATTERN) -> Column:
    """A timestamp as text, with the offset of the session time zone."""
    return F.date_format(stamp, pattern)


def load_date(stamp: str | Column) -> Column:
    """The calendar day of a timestamp in the session time zone."""
    return F.to_date(stamp)
