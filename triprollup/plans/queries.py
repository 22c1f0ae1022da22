"""The queries registered with the driver, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triprollup.functions.time import format_stamp, load_date
from triprollup.operators.decode import (
    CSV,
    JSON,
    QUARANTINE,
    decode_documents,
    decode_json,
    decode_lines,
    decode_trips,
    encode_json,
    encode_lines,
    rejected_lines,
)
from triprollup.operators.drilldown import drill_down
from triprollup.operators.preview import column_counts, preview, schema_listing
from triprollup.operators.rollup import batch_rollup, reaggregate
from triprollup.plans import incremental, reports
from triprollup.plans.lineitem_trips import (
    BATCH,
    BATCH_KEYS,
    damaged_documents,
    damaged_lines,
    plain_trips,
    trips,
    write_feed,
)
from triprollup.schemas import (
    DECIMALS,
    GROUP_KEYS,
    RAW_TABLE_SCHEMA,
    REASON,
    REJECT_TABLE_SCHEMA,
    ROLLUP_TABLE_SCHEMA,
    STAMP,
    TRIP_COLUMNS,
)
from triprollup.sinks.keyed import KeyedTable, define_keyed
from triprollup.sinks.ledger import landed_batches, landed_table
from triprollup.sinks.retention import reading, remove_compacted
from triprollup.sinks.tables import (
    append_stamped,
    append_trips,
    compact,
    define_namespace,
    define_table,
    discover_partitions,
    overwrite_table,
    upsert_rollup,
    write_partitions,
)
from triprollup.sources.evolved import evolved_table
from triprollup.sources.inferred import csv_inferred
from triprollup.sources.messages import (
    count_messages,
    line_messages,
    line_stream,
    project_key_value,
)
from triprollup.sources.offsets import TOPIC_PARTITION, offset_faults, offset_range_read
from triprollup.sources.scratch import scratch_path
from triprollup.sources.tables import (
    as_trips,
    csv_file,
    merged_schema_table,
    parquet_table,
    raw_table,
    reject_table,
    rollup_table,
    with_history,
)
from triprollup.streaming.ingest import run_ingest
from triprollup.streaming.progress import batch_progress, recorded

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# How many micro-batches a registered stream query cuts its feed into, about.
MICRO_BATCHES = 3


def registered(query: Query) -> Query:
    """Register under the function's name, less the ending that avoids a clash."""
    QUERIES[query.__name__.removesuffix("_query")] = query
    return query


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _own(name: str) -> str:
    """A name that no other run has."""
    return f"{name}_{uuid4().hex}"


def _rollup(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return batch_rollup(trips(spark, sf_dir), BATCH_KEYS, decimals=DECIMALS, **options)


def _stored_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup of all trips, read back from a table written for it."""
    path = scratch_path(spark, "rollup")
    write_partitions(_rollup(spark, sf_dir), path, BATCH)
    return _keyed_table(spark, path)


def _keyed_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored rollup; the key read from directory names gets its type back."""
    return parquet_table(spark, path).withColumn(BATCH, F.col(BATCH).cast("bigint"))


# Reports


@registered
def report_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_raw(trips(spark, sf_dir), DECIMALS)


@registered
def report_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_rollup(_stored_rollup(spark, sf_dir), DECIMALS)


@registered
def report_rollup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reaggregate(_stored_rollup(spark, sf_dir), GROUP_KEYS, decimals=DECIMALS)


@registered
def report_sum_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_takings(trips(spark, sf_dir), DECIMALS)


@registered
def reconcile_raw_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.reconcile_reports(
        trips(spark, sf_dir), _stored_rollup(spark, sf_dir), DECIMALS
    )


@registered
def timed_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is the same in every run of the timing, opening the stored rollup included."""
    path = scratch_path(spark, "rollup")
    write_partitions(_rollup(spark, sf_dir), path, BATCH)
    timed = reports.timed_reports(
        lambda: trips(spark, sf_dir),
        lambda: _keyed_table(spark, path),
        rounds=2,
        decimals=DECIMALS,
    )
    ended = F.col("ended_at") >= F.col("started_at")
    return timed.select("round", "report", "n_rows", ended.alias("ended"))


# Rollups


@registered
def rollup_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rollup(spark, sf_dir)


@registered
def rollup_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rollup(spark, sf_dir, stats=["sum"], count=None)


@registered
def rollup_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rollup(spark, sf_dir, stats=["max"], count=None)


@registered
def rollup_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rollup(spark, sf_dir, stats=["avg"], count=None)


@registered
def rollup_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rollup(spark, sf_dir, stats=[])


@registered
def sum_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_rollup(
        trips(spark, sf_dir), GROUP_KEYS, ["passenger_count"], ["sum"], count=None
    )


@registered
def rollup_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rollup with a constant and a derived datetime column put on afterwards."""
    rollup = _rollup(spark, sf_dir, measures=["total_amount"], stats=["sum"])
    return rollup.withColumns(
        {
            "report_date": F.lit("2016-01-01").cast("date"),
            "batch_start": F.make_date(F.col(BATCH).cast("int"), F.lit(1), F.lit(1)),
        }
    )


# Decoding


@registered
def csv_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_trips(encode_lines(plain_trips(spark, sf_dir)))


@registered
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = rejected_lines(decode_lines(damaged_lines(plain_trips(spark, sf_dir))))
    return refused.groupBy(REASON).agg(F.count(F.lit(1)).alias("n_lines"))


@registered
def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = rejected_lines(decode_documents(damaged_documents(trips(spark, sf_dir))))
    return refused.groupBy(REASON).agg(F.count(F.lit(1)).alias("n_lines"))


@registered
def reconcile_altered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of all trips against that of all but one group's, one group's altered."""
    source = trips(spark, sf_dir)
    altered = source.filter("not (vendor_id = 'A' and payment_type = '1')").withColumn(
        "total_amount",
        F.when(
            (F.col("vendor_id") == "R") & (F.col("payment_type") == "2"), F.lit(1.0)
        ).otherwise(F.col("total_amount")),
    )
    rollup = batch_rollup(altered, BATCH_KEYS, decimals=DECIMALS)
    return reports.reconcile_reports(source, rollup, DECIMALS)


def _partitioned(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """Rows stored by batch, read back with the schema they have."""
    path = scratch_path(spark, label)
    write_partitions(rows, path, BATCH)
    return spark.read.schema(rows.schema).parquet(path)


@registered
def reconcile_drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that differ between all trips and a copy with two batches altered.

    In 1995 a fifth of the totals are other ones, of 1996 the cash trips of one vendor are gone
    and those of another are there twice.
    """
    source = trips(spark, sf_dir)
    vendor, kind = F.col("vendor_id"), F.col("payment_type")
    changed = (F.col(BATCH) == 1995) & (kind == "2")
    altered = source.withColumn(
        "total_amount", F.when(changed, 1.0).otherwise(F.col("total_amount"))
    )
    cash = (F.col(BATCH) == 1996) & (kind == "1")
    copies = F.when(cash & (vendor == "A"), 0).when(cash & (vendor == "N"), 2).otherwise(1)
    altered = altered.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("_copy")
    sides = _partitioned(spark, source, "left"), _partitioned(spark, altered, "right")
    return drill_down(*sides, BATCH, GROUP_KEYS)


@registered
def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the damaged lines, by vendor and payment type."""
    good = decode_trips(damaged_lines(plain_trips(spark, sf_dir)), mode=QUARANTINE)
    return good.groupBy(*GROUP_KEYS).agg(
        F.count(F.lit(1)).alias("n_trips"),
        F.count_if(F.isnan("total_amount")).alias("n_nan"),
        F.sum("passenger_count").alias("sum_passenger_count"),
    )


@registered
def kv_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    envelopes = _table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
    )
    return project_key_value(envelopes)


@registered
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_json(encode_json(plain_trips(spark, sf_dir)))


@registered
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType([T.StructField("k", T.LongType())])
    return decode_json(
        _table(spark, sf_dir, "events"), schema, value="props", keep=["event_id"]
    )


@registered
def stamp_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.col("ts").cast("timestamp")
    return _table(spark, sf_dir, "events").select(
        "event_id", format_stamp(stamp).alias("stamp")
    )


@registered
def load_date_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        "event_id", load_date("ts").alias("load_date")
    )


# Files and tables


@registered
def csv_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    plain_trips(spark, sf_dir).write.option("header", True).csv(path)
    return as_trips(csv_file(spark, path))


@registered
def csv_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    plain_trips(spark, sf_dir).write.option("header", True).csv(path)
    return csv_file(spark, path)


def _inferred_trips(spark: SparkSession, sf_dir: str, header: bool) -> DataFrame:
    path = scratch_path(spark, "csv")
    plain_trips(spark, sf_dir).write.option("header", header).csv(path)
    return csv_inferred(spark, path, header, None if header else TRIP_COLUMNS)


@registered
def csv_inferred_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips in the types that their values show; stamps as text, which all engines print alike."""
    found = _inferred_trips(spark, sf_dir, header=True)
    stamps = [f.name for f in found.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in stamps})


@registered
def csv_inferred_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_listing(_inferred_trips(spark, sf_dir, header=False))


@registered
def append_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts seen through a view before and after a second append."""
    path, view = scratch_path(spark, "appended"), "appended_trips"
    source = plain_trips(spark, sf_dir)
    append_trips(source, path)
    reports.register(parquet_table(spark, path), view)
    before = spark.sql(f"select count(*) as n from {view}").first()["n"]
    append_trips(source, path)
    reports.refresh(spark, view)
    return spark.sql(
        f"select vendor_id, count(*) as n_trips, {before}L as n_before "
        f"from {view} group by vendor_id"
    )


@registered
def merge_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips without and with a stamp in one directory."""
    path = scratch_path(spark, "merged")
    source = plain_trips(spark, sf_dir)
    append_trips(source, path)
    stamp = F.col("tpep_pickup_datetime").cast("timestamp")
    append_trips(source.withColumn(STAMP, stamp), path)
    return (
        merged_schema_table(spark, path)
        .groupBy("vendor_id")
        .agg(
            F.count(F.lit(1)).alias("n_trips"),
            F.count(STAMP).alias("n_stamped"),
            F.max(F.date_format(STAMP, "yyyy-MM-dd")).alias("last_stamp"),
        )
    )


@registered
def upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup of all trips, then upon it that of the trips at rate code F."""
    path = scratch_path(spark, "upserted")
    source = trips(spark, sf_dir)
    for load in (source, source.filter(F.col("rate_code_id") == "F")):
        rollup = batch_rollup(load, BATCH_KEYS, decimals=DECIMALS)
        upsert_rollup(rollup, path, BATCH_KEYS, partition=BATCH)
    return _keyed_table(spark, path)


def _keyed_rollup(
    spark: SparkSession, source: DataFrame, order: Sequence[str] = ()
) -> KeyedTable:
    """A keyed table for rollups of this source."""
    return define_keyed(spark, scratch_path(spark, "keyed"), source.schema, BATCH_KEYS, BATCH, order)


@registered
def upsert_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loads of `upsert_last_wins`, into a keyed table that changes at once."""
    source = trips(spark, sf_dir)
    loads = [
        batch_rollup(load, BATCH_KEYS, decimals=DECIMALS)
        for load in (source, source.filter(F.col("rate_code_id") == "F"))
    ]
    table = _keyed_rollup(spark, loads[0])
    for load in loads:
        table.upsert(load)
    table.remove_stale(0)
    return table.rows()


@registered
def upsert_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollups whose writes are numbered; a key is given up to three times in a load.

    First that of all trips, as write 2. Then those of one rate code each as writes 1, 3 and 4
    in one load, of which the first is older than what is stored.
    """
    source = trips(spark, sf_dir)

    def written(number: int, load: DataFrame) -> DataFrame:
        rollup = batch_rollup(load, BATCH_KEYS, ["total_amount"], ["sum"], decimals=DECIMALS)
        return rollup.withColumn("write_number", F.lit(number).cast("bigint"))

    first = written(2, source)
    rate, flag = F.col("rate_code_id"), F.col("store_and_fwd_flag")
    second = written(1, source.filter(rate == "F"))
    second = second.unionByName(written(3, source.filter(rate == "O")))
    second = second.unionByName(written(4, source.filter(flag == "Y")))
    table = _keyed_rollup(spark, first, ["write_number"])
    table.upsert(first)
    table.upsert(second)
    return table.rows()


@registered
def report_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds of a stored report over a batch a year, which come in three loads.

    First the even years, of each the trips at rate code F only; then the odd years; then the
    even years again, whole.
    """
    path, state = scratch_path(spark, "raw"), scratch_path(spark, "report")
    year = F.make_timestamp(F.col(BATCH).cast("int"), *map(F.lit, (1, 1, 0, 0, 0)), F.lit("UTC"))
    stamped = trips(spark, sf_dir).withColumn(STAMP, year).drop(BATCH)
    even = F.year(STAMP) % 2 == 0
    loads = (
        stamped.filter(even & (F.col("rate_code_id") == "F")),
        stamped.filter(~even),
        stamped.filter(even),
    )
    for load in loads:
        append_stamped(load, path)
        report = incremental.report_incremental(spark, path, state, DECIMALS)
    return report


@registered
def named_rollup_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A defined table filled by partitions and read by its name."""
    name, path = f"trip_reports.{_own('batch_rollups')}", scratch_path(spark, "named")
    define_namespace(spark, "trip_reports", scratch_path(spark, "namespace"))
    rollup = _rollup(spark, sf_dir)
    define_table(spark, name, path, rollup.schema, partition=BATCH)
    write_partitions(rollup, path, BATCH)
    discover_partitions(spark, name)
    return spark.table(name)


@registered
def overwritten_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named table written twice; the second rollup is what stays."""
    name, path = _own("overwritten_trips"), scratch_path(spark, "overwritten")
    source = trips(spark, sf_dir)
    overwrite_table(batch_rollup(source, BATCH_KEYS, decimals=DECIMALS), name, path)
    overwrite_table(batch_rollup(source, GROUP_KEYS, decimals=DECIMALS), name, path)
    return spark.table(name)


@registered
def decoded_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines decoded, rolled up and saved straight to the keyed table."""
    path = scratch_path(spark, "decoded")
    lines = encode_lines(trips(spark, sf_dir), keep=[BATCH])
    rollup = batch_rollup(decode_trips(lines, keep=[BATCH]), BATCH_KEYS, decimals=DECIMALS)
    upsert_rollup(rollup, path, BATCH_KEYS, partition=BATCH)
    return _keyed_table(spark, path)


@registered
def bounded_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "messages")
    write_feed(_table(spark, sf_dir, "events").selectExpr("props as value"), path)
    return line_messages(spark, path)


@registered
def bounded_read_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "messages")
    write_feed(_table(spark, sf_dir, "events").selectExpr("props as value"), path)
    return count_messages(line_messages(spark, path))


def _offset_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages of four partitions, stored by partition."""
    path = scratch_path(spark, "messages")
    messages = _table(spark, sf_dir, "events").selectExpr(
        "cast(event_id % 4 as int) as partition",
        "cast(floor(event_id / 4) as bigint) as offset",
        "cast(user_id as string) as key",
        "props as value",
    )
    write_partitions(messages, path, TOPIC_PARTITION)
    return spark.read.schema("offset bigint, key string, value string, partition int").parquet(path)


#: Partitions of the registered offset queries: part of one, all of another, none of a third.
OFFSET_RANGES = {0: (10, 150), 1: (0, 1 << 40), 3: (7, 7)}


@registered
def offset_range_read_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offset_range_read(_offset_messages(spark, sf_dir), OFFSET_RANGES)


@registered
def offset_faults_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some are lost and some are delivered twice."""
    messages = _offset_messages(spark, sf_dir)
    number = F.col("offset") * 4 + F.col("partition")
    copies = F.when(number % 97 < 2, 0).when(number % 89 == 0, 3).otherwise(1)
    delivered = messages.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies)))
    return offset_faults(delivered.drop("_copy"), {p: (0, 2_000) for p in range(3)})


def _narrowed(spark: SparkSession, rows: DataFrame, column: str) -> DataFrame:
    """A few rows, stored; a column of whole decimals is bigint if all its values are."""
    path = scratch_path(spark, "narrowed")
    stored = parquet_table(spark, _written(rows, path))
    whole = F.col(column).try_cast("bigint")
    grown = stored.filter(F.col(column).isNotNull() & whole.isNull())
    return stored.withColumn(column, whole) if grown.isEmpty() else stored


@registered
def evolved_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips written three times, as counts and amounts grew and a column came.

    The sum of counts is a decimal once it has grown out of bigint.
    """
    path = scratch_path(spark, "evolved")
    source = plain_trips(spark, sf_dir)
    narrow = source.select(
        "vendor_id",
        F.col("passenger_count").cast("int").alias("passenger_count"),
        F.col("trip_distance").cast("float").alias("trip_distance"),
    )
    wide = source.select("vendor_id", (F.col("passenger_count") + (1 << 40)).alias("passenger_count"))
    for generation in (narrow, wide, source.select("payment_type", "trip_distance", "vendor_id")):
        append_trips(generation, path)
    found = (
        evolved_table(spark, path)
        .groupBy("vendor_id")
        .agg(
            F.count(F.lit(1)).alias("n_trips"),
            F.sum(F.col("passenger_count").cast("decimal(20, 0)")).alias("sum_passenger_count"),
            F.count("trip_distance").alias("n_distances"),
            F.max("trip_distance").alias("max_trip_distance"),
            F.count("payment_type").alias("n_payments"),
        )
    )
    return _narrowed(spark, found, "sum_passenger_count")


@registered
def preview_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(plain_trips(spark, sf_dir), order=TRIP_COLUMNS)


@registered
def preview_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(_rollup(spark, sf_dir), order=BATCH_KEYS, rows=10)


@registered
def schema_listing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_listing(plain_trips(spark, sf_dir))


@registered
def column_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_counts(plain_trips(spark, sf_dir))


# Streams


def _ingested(
    spark: SparkSession,
    messages: DataFrame,
    by: str | None = None,
    quarantine: bool = False,
    form: str = CSV,
) -> dict[str, str]:
    """Write messages as files, ingest them in several micro-batches, tell the table paths."""
    feed = scratch_path(spark, "feed")
    size = write_feed(messages, feed, by)
    paths = {name: scratch_path(spark, name) for name in ("raw", "rollup", "checkpoint")}
    options = {}
    if quarantine:
        options = {"mode": QUARANTINE, "rejects": scratch_path(spark, "rejects")}
    limit = max(1, size // MICRO_BATCHES)
    stream = line_stream(spark, feed, maxBytesPerTrigger=limit)
    run_ingest(stream, form=form, decimals=DECIMALS, **paths, **options)
    return {**paths, **options}


def _trip_feed(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    return _ingested(spark, encode_lines(trips(spark, sf_dir), keep=[BATCH]), by=BATCH)


@registered
def stream_ingest_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _trip_feed(spark, sf_dir)
    return reports.report_raw(raw_table(spark, paths["raw"]), DECIMALS)


@registered
def stream_ingest_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _trip_feed(spark, sf_dir)
    return reports.report_rollup(rollup_table(spark, paths["rollup"]), DECIMALS)


@registered
def stream_ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = encode_json(trips(spark, sf_dir), keep=[BATCH])
    paths = _ingested(spark, documents, by=BATCH, form=JSON)
    return reports.report_rollup(rollup_table(spark, paths["rollup"]), DECIMALS)


@registered
def stream_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _trip_feed(spark, sf_dir)
    return reports.reconcile_reports(
        raw_table(spark, paths["raw"]), rollup_table(spark, paths["rollup"]), DECIMALS
    )


def _two_ingests(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Two streams into one pair of tables, each started three times; tells the paths.

    One takes the lines of odd batches, damaged, and keeps the refused ones aside; the other
    those of even batches, whole.
    """
    names = ("raw", "rollup", "rejects", "ledger")
    paths = {name: scratch_path(spark, name) for name in names}
    source = trips(spark, sf_dir)
    odd = F.col(BATCH) % 2 == 1
    feeds = (
        (damaged_lines(source.filter(odd)), {"mode": QUARANTINE, "rejects": paths["rejects"]}),
        (encode_lines(source.filter(~odd)), {}),
    )
    for lines, options in feeds:
        feed, checkpoint = scratch_path(spark, "feed"), scratch_path(spark, "checkpoint")
        size = write_feed(lines, feed)
        stream = line_stream(spark, feed, maxBytesPerTrigger=max(1, size // MICRO_BATCHES))
        for _ in range(3):
            run_ingest(
                stream, paths["raw"], paths["rollup"], checkpoint,
                decimals={"fare_amount": DECIMALS}, ledger=paths["ledger"], **options,
            )
    return paths


@registered
def stream_two_ingests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips and fares of the rollup of both ingests, from batches that have landed."""
    paths = _two_ingests(spark, sf_dir)
    rollup = landed_table(spark, paths["rollup"], paths["ledger"], ROLLUP_TABLE_SCHEMA)
    return reaggregate(
        rollup, GROUP_KEYS, ["fare_amount"], ["sum", "max"], decimals=DECIMALS
    )


@registered
def ingest_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger of two ingests tells, and what their tables hold."""
    paths = _two_ingests(spark, sf_dir)

    def rows(name: str, schema: T.StructType) -> Column:
        table = landed_table(spark, paths[name], paths["ledger"], schema)
        return F.lit(table.count()).alias(f"n_{name}")

    return landed_batches(spark, paths["ledger"]).agg(
        F.count_distinct("ingest").alias("n_ingests"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_refused").alias("n_refused"),
        rows("raw", RAW_TABLE_SCHEMA),
        rows("rejects", REJECT_TABLE_SCHEMA),
    )


@registered
def batch_progress_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of two ingests: how many were recorded, and their rows."""
    path = scratch_path(spark, "progress")
    with recorded(spark, path):
        paths = _two_ingests(spark, sf_dir)
    told = batch_progress(spark, path, paths["ledger"], interval_seconds=3600)
    return told.agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_refused").alias("n_refused"),
        F.count_if(F.col("duration_ms").isNull()).alias("n_unrecorded"),
        F.count_if(F.col("started_at") > F.col("landed_at")).alias("n_out_of_order"),
        F.count_if("is_late").alias("n_late"),
    )


@registered
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons of the lines a quarantining ingest refused."""
    lines = damaged_lines(plain_trips(spark, sf_dir))
    paths = _ingested(spark, lines, quarantine=True)
    refused = reject_table(spark, paths["rejects"])
    return refused.groupBy(REASON).agg(F.count(F.lit(1)).alias("n_lines"))


@registered
def compacted_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup report of a table of a batch a year, all but the last three compacted.

    The first is compacted again once the live table lacks it.
    """
    path, history = scratch_path(spark, "rollup"), scratch_path(spark, "history")
    year = F.make_timestamp(F.col(BATCH).cast("int"), *map(F.lit, (1, 1, 0, 0, 0)), F.lit("UTC"))
    stamped = trips(spark, sf_dir).withColumn(STAMP, year)
    append_stamped(batch_rollup(stamped, decimals=DECIMALS), path)
    live = rollup_table(spark, path)
    years = live.select(F.year(STAMP).alias("year")).distinct().orderBy("year").collect()
    days = [f"{r['year']}-01-01" for r in years[:-3]]
    for day in days:
        compact(live, history, day, join_files=True)
    pruned = live.filter(F.col(STAMP) != F.lit(f"{days[0]} 00:00:00+00:00").cast("timestamp"))
    compact(pruned, history, days[0])
    return reports.report_rollup(with_history(pruned, history), DECIMALS)


@registered
def compacted_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup report of a batch a year, of which those in the history are removed.

    One of them is replayed afterwards, and what is left is compacted and removed once more.
    """
    path, history = scratch_path(spark, "rollup"), scratch_path(spark, "history")
    year = F.make_timestamp(F.col(BATCH).cast("int"), *map(F.lit, (1, 1, 0, 0, 0)), F.lit("UTC"))
    stamped = trips(spark, sf_dir).withColumn(STAMP, year)
    append_stamped(batch_rollup(stamped, decimals=DECIMALS), path)
    for first in ("1992", "1993"):
        live = rollup_table(spark, path)
        for later in range(2):
            compact(live, history, f"{int(first) + later}-01-01", join_files=True)
        remove_compacted(spark, path, history, retention_seconds=0)
        replayed = batch_rollup(stamped.filter(F.year(STAMP) == 1992), decimals=DECIMALS)
        append_stamped(replayed, path)
    with reading(spark, history):
        whole = with_history(rollup_table(spark, path), history)
        report = reports.report_rollup(whole, DECIMALS)
        return parquet_table(spark, _written(report, scratch_path(spark, "report")))


def _written(df: DataFrame, path: str) -> str:
    df.write.parquet(path)
    return path
