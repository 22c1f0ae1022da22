"""Looking at a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREVIEW_ROWS = 20


def preview(df: DataFrame, order: Sequence[str] = (), rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows; in a given order each task keeps only its own first ones."""
    return (df.orderBy(*order) if order else df).limit(rows)


def show(df: DataFrame, rows: int = PREVIEW_ROWS) -> None:
    """Print the first rows."""
    df.show(rows)


def schema_listing(df: DataFrame) -> DataFrame:
    """One row per column: position, name and type. No row of the table is read."""
    entries = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("column_type"),
        )
        for position, field in enumerate(df.schema.fields)
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*entries)))


def column_counts(df: DataFrame) -> DataFrame:
    """One row per column: name, and how many rows hold a value in it. Reads all columns."""
    counted = df.agg(*(F.count(F.col(f"`{name}`")).alias(name) for name in df.columns))
    entries = [
        F.struct(F.lit(name).alias("column_name"), F.col(f"`{name}`").alias("n_values"))
        for name in df.columns
    ]
    return counted.select(F.inline(F.array(*entries)))
