"""Fixed schemas of the trip record, the raw table and the rollup table."""

from __future__ import annotations

from pyspark.sql import types as T

# The 19 fields of one trip line, in line order.
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("vendor_id", T.StringType()),
        T.StructField("tpep_pickup_datetime", T.StringType()),
        T.StructField("tpep_dropoff_datetime", T.StringType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("pickup_longitude", T.FloatType()),
        T.StructField("pickup_latitude", T.FloatType()),
        T.StructField("rate_code_id", T.StringType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("dropoff_longitude", T.FloatType()),
        T.StructField("dropoff_latitude", T.FloatType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
    ]
)

TRIP_COLUMNS = TRIP_SCHEMA.fieldNames()

# The processing-time stamp of the micro-batch, and the partition it lands in.
STAMP = "trip_date"
PARTITION = "batch_ms"

STAMPED_TRIP_SCHEMA = T.StructType(
    [T.StructField(STAMP, T.TimestampType()), *TRIP_SCHEMA.fields]
)
RAW_TABLE_SCHEMA = T.StructType(
    [*STAMPED_TRIP_SCHEMA.fields, T.StructField(PARTITION, T.LongType())]
)

# What a rollup groups by and what it aggregates.
GROUP_KEYS = ("vendor_id", "payment_type")
ROLLUP_KEYS = (STAMP, *GROUP_KEYS)
MEASURES = (
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
)
STATS = ("sum", "max", "avg")
COUNT_COLUMN = "count_trips"
# Money and distance are quoted with this many decimals.
DECIMALS = 2


def rollup_schema() -> T.StructType:
    """Schema of the stored rollup: the key, three statistics a measure, the count."""
    fields = [
        T.StructField(STAMP, T.TimestampType()),
        *(T.StructField(key, T.StringType()) for key in GROUP_KEYS),
    ]
    for measure in MEASURES:
        plain = TRIP_SCHEMA[measure].dataType
        for stat in STATS:
            kind = T.DoubleType() if stat == "avg" else plain
            fields.append(T.StructField(f"{stat}_{measure}", kind))
    fields.append(T.StructField(COUNT_COLUMN, T.LongType()))
    return T.StructType(fields)


ROLLUP_SCHEMA = rollup_schema()
ROLLUP_TABLE_SCHEMA = T.StructType(
    [*ROLLUP_SCHEMA.fields, T.StructField(PARTITION, T.LongType())]
)

# What a quarantined message keeps.
REASON = "reject_reason"
LINE = "line"
REJECT_TABLE_SCHEMA = T.StructType(
    [
        T.StructField(STAMP, T.TimestampType()),
        T.StructField(LINE, T.StringType()),
        T.StructField(REASON, T.StringType()),
        T.StructField(PARTITION, T.LongType()),
    ]
)
