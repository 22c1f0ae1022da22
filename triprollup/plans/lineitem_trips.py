"""Trips derived from the order lines of the driver's tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triprollup.schemas import GROUP_KEYS, TRIP_COLUMNS
from triprollup.sinks.files import stored_bytes

# Stand-in for the stamp of a micro-batch, which no oracle could know.
BATCH = "batch_id"
BATCH_KEYS = (BATCH, *GROUP_KEYS)

# Which column of an order line plays which part of a trip.
TRIP_EXPRESSIONS = """
  l_returnflag as vendor_id,
  cast(l_shipdate as string) as tpep_pickup_datetime,
  cast(l_shipdate + interval '1' hour as string) as tpep_dropoff_datetime,
  cast(l_quantity as bigint) as passenger_count,
  l_tax as trip_distance,
  cast(-73.9 - l_discount as float) as pickup_longitude,
  cast(40.7 + l_tax as float) as pickup_latitude,
  l_linestatus as rate_code_id,
  case when l_linenumber = 1 then 'Y' else 'N' end as store_and_fwd_flag,
  cast(-73.9 + l_discount as float) as dropoff_longitude,
  cast(40.7 - l_tax as float) as dropoff_latitude,
  cast(l_linenumber as string) as payment_type,
  l_extendedprice as fare_amount,
  cast(0.5 as double) as extra,
  cast(0.5 as double) as mta_tax,
  l_discount as tip_amount,
  cast(0 as double) as tolls_amount,
  cast(0.3 as double) as improvement_surcharge,
  l_extendedprice + l_tax + l_discount as total_amount,
  cast(year(l_shipdate) as bigint) as batch_id
"""
TRIP_SQL = f"select {TRIP_EXPRESSIONS} from {{source}}"


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order lines as trips, with ``batch_id``."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return spark.sql(TRIP_SQL, source=lines)


def plain_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 19 columns of a trip only."""
    return trips(spark, sf_dir).select(*TRIP_COLUMNS)


def damaged_lines(good: DataFrame) -> DataFrame:
    """One line per trip, most of them damaged, the damage depending on payment type.

    1 stays whole, but vendor A gets the accepted total ``NaN`` and vendor R the
    refused ``nan``; 2 loses the last field; 3 has it empty; 4 gets two empty fields
    more, which do not count; 5 has a decimal point in the passenger count, 6 a letter
    for the distance, 7 a passenger count beyond 32 bits.
    """

    # A line is put together once, of fields that know their damage: nulls are left out of it.
    changed = {
        "passenger_count": "case when payment_type in ('1', '2', '3', '4', '6') then cast(passenger_count as string) "
        "when payment_type = '5' then concat(passenger_count, '.0') else '2147483648' end",
        "trip_distance": "if(payment_type = '6', 'x', cast(trip_distance as string))",
        "total_amount": "case when payment_type = '1' and vendor_id = 'A' then 'NaN' "
        "when payment_type = '1' and vendor_id = 'R' then 'nan' when payment_type = '2' then null "
        "when payment_type = '3' then '' else cast(total_amount as string) end",
    }
    fields = (changed.get(name, f"cast({name} as string)") for name in TRIP_COLUMNS)
    line = F.expr(f"concat_ws(',', {', '.join(fields)})")
    end = F.when(F.col("payment_type") == "4", ",,").otherwise("")
    return good.select(F.concat(line, end).alias("value"))


def damaged_documents(good: DataFrame) -> DataFrame:
    """One JSON message per trip, most of them damaged, depending on payment type.

    1 stays whole; 2 is blank; 3 is empty; 4 has text behind the document; 5 is two joined
    documents, 6 two with a comma; 7 closes a bracket that it did not open.
    """
    document = F.to_json(F.struct(*TRIP_COLUMNS))
    kind = F.col("payment_type")
    return good.select(
        F.when(kind == "1", document)
        .when(kind == "2", F.lit("  "))
        .when(kind == "3", F.lit(""))
        .when(kind == "4", F.concat(document, F.lit(" and more")))
        .when(kind == "5", F.concat(document, document))
        .when(kind == "6", F.concat(document, F.lit(","), document))
        .otherwise(F.concat(document, F.lit("]")))
        .alias("value")
    )


#: Folders that a task writes to side by side; beyond these it sorts its lines by folder.
OPEN_FOLDERS = 32
#: Lines of a file at most: a compressed file is read by one task.
FILE_LINES = 1 << 17


@contextmanager
def _side_by_side(spark: SparkSession) -> Iterator[None]:
    """Tasks write to several folders at a time, and need not sort whole lines for it."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, OPEN_FOLDERS)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_feed(lines: DataFrame, path: str, by: str | None = None) -> int:
    """Write lines as compressed text files, in subdirectories ``by`` a column, and tell their bytes."""
    spark = lines.sparkSession
    writer = lines.write.mode("error").option("compression", "lz4").option("maxRecordsPerFile", FILE_LINES)
    with _side_by_side(spark):
        (writer.partitionBy(by) if by else writer).text(path)
    return stored_bytes(spark, path)
