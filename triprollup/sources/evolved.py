"""Parquet directories whose files changed their columns and types over time.

Files are taken in the order they were written and grouped where their schemas can be merged:
Spark merges the footers of a stretch of files in one distributed job, and a stretch that cannot
be merged is halved. Types that grew are widened over all groups; each group is then scanned
once, in its own types, and cast. Columns that a file lacks are null.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Each type can hold all values of those before it in a row.
WIDENINGS: tuple[tuple[type[T.DataType], ...], ...] = (
    (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    (T.ByteType, T.ShortType, T.IntegerType, T.DoubleType),
    (T.FloatType, T.DoubleType),
    (T.DateType, T.TimestampNTZType),
)


class CannotWiden(ValueError):
    """A column has types over time of which none holds the other's values."""


def wider(name: str, one: T.DataType, other: T.DataType) -> T.DataType:
    """The type that holds all values of both; structs, arrays and maps are widened inside."""
    if one == other:
        return one
    kinds = type(one), type(other)
    for row in WIDENINGS:
        if kinds[0] in row and kinds[1] in row:
            return max(one, other, key=lambda t: row.index(type(t)))
    if kinds == (T.DecimalType, T.DecimalType):
        scale = max(one.scale, other.scale)
        whole = max(one.precision - one.scale, other.precision - other.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    if kinds == (T.StructType, T.StructType):
        return widened([one, other], f"{name}.")
    if kinds == (T.ArrayType, T.ArrayType):
        return T.ArrayType(wider(f"{name}[]", one.elementType, other.elementType))
    if kinds == (T.MapType, T.MapType):
        key = wider(f"{name} key", one.keyType, other.keyType)
        return T.MapType(key, wider(f"{name}{{}}", one.valueType, other.valueType))
    raise CannotWiden(f"{name} is {one.simpleString()} and {other.simpleString()}")


def widened(schemas: Sequence[T.StructType], prefix: str = "") -> T.StructType:
    """All columns of these schemas, in the order they came, each in its widest type."""
    found: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema.fields:
            known = found.get(field.name, field.dataType)
            found[field.name] = wider(prefix + field.name, known, field.dataType)
    return T.StructType([T.StructField(name, kind) for name, kind in found.items()])


def files_in_order(spark: SparkSession, path: str) -> list[str]:
    """Parquet files of a directory from the oldest on; their paths, as a scan lists them."""
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return [r["path"] for r in listed.select("path", "modificationTime").orderBy("modificationTime", "path").collect()]


def _reader(spark: SparkSession, path: str):
    return spark.read.option("basePath", path).option("mergeSchema", True)


def schema_groups(
    spark: SparkSession, path: str, files: Sequence[str]
) -> list[tuple[T.StructType, list[str]]]:
    """Stretches of files whose schemas Spark can merge, each with its merged schema.

    Footers are read by tasks. With few schemas over time, each change costs a job for every
    halving of its stretch, not one for each file.
    """
    try:
        return [(_reader(spark, path).parquet(*files).schema, list(files))]
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error) or len(files) == 1:
            raise
    half = len(files) // 2
    return [
        *schema_groups(spark, path, files[:half]),
        *schema_groups(spark, path, files[half:]),
    ]


def _as(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value in the wider type; fields that a struct lacks are null."""
    if have == want:
        return column
    if isinstance(want, T.StructType):
        fields = [
            (
                _as(column[f.name], have[f.name].dataType, f.dataType)
                if f.name in have.fieldNames()
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in want.fields
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType):
        return F.transform(column, lambda v: _as(v, have.elementType, want.elementType))
    if isinstance(want, T.MapType):
        keys = F.transform_keys(column, lambda k, _: _as(k, have.keyType, want.keyType))
        return F.transform_values(keys, lambda _, v: _as(v, have.valueType, want.valueType))
    return column.cast(want)


def evolved_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet directory as one table with all columns its files ever had, in their widest types.

    Whole numbers grow up to bigint, or to double from 32 bits on; floats to double, dates to
    timestamps without a zone, decimals in both directions. Anything else that changed its type
    fails with :class:`CannotWiden` before a row is read. An empty directory fails as Spark's
    reader does.
    """
    path = path.rstrip("/")
    files = files_in_order(spark, path)
    if not files:
        return spark.read.parquet(path)
    groups = schema_groups(spark, path, files)
    whole = widened([schema for schema, _ in groups])
    parts: dict[str, list] = {}
    # Stretches with one schema are one scan, wherever they lie.
    for schema, some in groups:
        parts.setdefault(schema.json(), [schema, []])[1].extend(some)
    found = None
    for schema, some in parts.values():
        rows = _reader(spark, path).schema(schema).parquet(*some)
        cast = [
            _as(F.col(f"`{f.name}`"), schema[f.name].dataType, f.dataType).alias(f.name)
            if f.name in schema.fieldNames()
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in whole.fields
        ]
        rows = rows.select(*cast)
        found = rows if found is None else found.unionByName(rows)
    return found
