"""CSV files whose types are not known: found in one pass over all lines.

Types form a lattice. Below all are columns without a value; a column of whole numbers may turn
out to be one of doubles, a column of dates one of timestamps, and everything a column of texts.
A value tells the least type that has it, and a column's type is the least one that has all its
values. That is a fold of two small numbers for each column: a task keeps them whatever it reads, and
nothing else is shuffled. No line is left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a value must look like, besides being castable: casts take more, such as blanks or `1d`.
WHOLE_TEXT = r"^[+-]?[0-9]+\z"
NUMBER_TEXT = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z|^(?:NaN|-?Infinity)\z"
DATE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
TIME_TEXT = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,6})?"
    r"(?:Z|[+-][0-9]{2}:?[0-9]{2})?\z"
)
#: Two chains of types: of no type of the chain, the wider one, the narrower one. A whole number is
#: a double as well, and a date a timestamp; no value is in both chains.
NUMBERS: list[T.DataType | None] = [None, T.DoubleType(), T.LongType()]
TIMES: list[T.DataType | None] = [None, T.TimestampType(), T.DateType()]
#: Characters, sign included, that a whole number beyond 64 bits has at least.
LARGE = 19


def text_columns(
    spark: SparkSession, path: str, header: bool = True, names: Sequence[str] | None = None
) -> DataFrame:
    """A CSV file with every field as text, empty ones as null.

    Without a header columns are called _c0, _c1 and so on, unless `names` are given. Only the
    first line is read to count them. A line with more or fewer fields fails the job that reads
    it.
    """
    reader = spark.read.option("header", header)
    found = reader.csv(path).columns
    if names is not None:
        if len(names) != len(found):
            raise ValueError(f"{path} has {len(found)} columns, not {len(names)}")
        found = list(names)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in found])
    # All columns are read whichever are asked for: a pruned reader does not count fields.
    strict = reader.option("mode", "FAILFAST").option("enforceSchema", names is not None or not header)
    return strict.schema(schema).csv(path)


def _number(column: Column) -> Column:
    """How far down the chain of numbers a value is; null for null, which a fold passes over.

    Patterns are looked for only in texts that begin like one, as they cost most of a pass. What
    looks like a number always casts to a double, one that is whole and short to a bigint.
    """
    first = F.substring(column, 1, 1)
    begins = (first <= "9") | first.isin("N", "I")
    whole = ~F.contains(column, F.lit(".")) & column.rlike(WHOLE_TEXT)
    fits = (F.octet_length(column) < LARGE) | column.try_cast(T.LongType()).isNotNull()
    return F.when(
        begins,
        F.when(whole, F.when(fits, 2).otherwise(1)).when(column.rlike(NUMBER_TEXT), 1).otherwise(0),
    ).when(column.isNotNull(), 0)


def _time(column: Column) -> Column:
    """How far down the chain of times a value is, likewise."""
    dated = F.octet_length(column) == len("2016-01-01")
    day = dated & column.rlike(DATE_TEXT) & column.try_cast(T.DateType()).isNotNull()
    stamp = column.rlike(f"{DATE_TEXT}|{TIME_TEXT}") & column.try_cast(T.TimestampType()).isNotNull()
    return F.when(
        F.substring(column, 5, 1) == "-", F.when(day, 2).when(stamp, 1).otherwise(0)
    ).when(column.isNotNull(), 0)


def inferred_types(texts: DataFrame) -> T.StructType:
    """The type of each text column, by one aggregation over all rows.

    A column is as far down a chain as its least value. A column without a value is one of texts.
    A whole number beyond 64 bits makes its column one of doubles.
    """
    least = []
    for i, name in enumerate(texts.columns):
        column = F.col(f"`{name}`")
        least += [F.min(_number(column)).alias(f"{i}_number"), F.min(_time(column)).alias(f"{i}_time")]
    seen = texts.agg(*least).first()
    fields = []
    for i, name in enumerate(texts.columns):
        kind = NUMBERS[seen[f"{i}_number"] or 0] or TIMES[seen[f"{i}_time"] or 0]
        fields.append(T.StructField(name, kind or T.StringType()))
    return T.StructType(fields)


def as_types(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast to the types that were found for them; a value that is none fails."""
    return texts.select(
        *(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields)
    )


def csv_inferred(
    spark: SparkSession, path: str, header: bool = True, names: Sequence[str] | None = None
) -> DataFrame:
    """A CSV file in the types of its values. The file is read once to find them."""
    texts = text_columns(spark, path, header, names)
    return as_types(texts, inferred_types(texts))
