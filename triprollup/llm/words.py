"""Words and word shingles as SQL expressions.

A word is a run of characters other than the six ASCII white-space characters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SHINGLE = 5


def bound(value: Column, body) -> Column:
    """body(value) with the value computed once, however often the body names it.

    Projections are merged by the optimizer, which would repeat the value for each element
    a lambda is applied to; a one-element array binds it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The words of a text; an empty array for null."""
    split = F.split(F.coalesce(text, F.lit("")), SPACE)
    return F.filter(split, lambda w: w != "")


def shingles_of(words: Column, width: int = SHINGLE) -> Column:
    """A 64-bit hash for each window of `width` words, in order; empty if there is none."""

    def hashes(w: Column) -> Column:
        def one(i: Column) -> Column:
            return F.xxhash64(*[F.get(w, i + k) for k in range(width)])

        places = F.sequence(F.lit(0), F.size(w) - width)
        none = F.array().cast("array<bigint>")
        return F.when(F.size(w) >= width, F.transform(places, one)).otherwise(none)

    return bound(words, hashes)
