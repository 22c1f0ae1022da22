"""From a stream of messages to the raw table and the rollup table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from triprollup.functions.numbers import Decimals
from triprollup.functions.time import partition_value, processing_time
from triprollup.operators.decode import (
    CSV,
    QUARANTINE,
    STRICT,
    accepted_trips,
    decode_messages,
    rejected_lines,
    require_valid,
)
from triprollup.operators.preview import show
from triprollup.operators.rollup import batch_rollup
from triprollup.schemas import PARTITION, REASON, STAMP, STAMPED_TRIP_SCHEMA
from triprollup.sinks.ledger import ingest_path, is_landed, record_batch
from triprollup.sinks.tables import add_batch, batch_path, write_batch
from triprollup.sources.messages import project_value

EVERY_MINUTE = {"processingTime": "60 seconds"}
UNTIL_CAUGHT_UP = {"availableNow": True}


def stamped_messages(messages: DataFrame, mode: str = STRICT, form: str = CSV) -> DataFrame:
    """Decoded messages with the stamp of their micro-batch.

    The stamp belongs here, in the streaming plan: it is then one value for the whole
    batch, and the same one when the batch is replayed from the checkpoint.
    """
    stamped = project_value(messages).withColumn(STAMP, processing_time())
    decoded = decode_messages(stamped, keep=[STAMP], form=form)
    if mode == STRICT:
        return require_valid(decoded)
    if mode == QUARANTINE:
        return decoded
    raise ValueError(f"mode must be {STRICT!r} or {QUARANTINE!r}, not {mode!r}")


def roll_up_batch(
    spark: SparkSession, raw: str, rollup: str, batch_ms: int, decimals: Decimals
) -> None:
    """Aggregate one stored batch into its rollup partition.

    Reading the batch back takes the seven columns needed from Parquet. The source is
    read once, no batch has to fit into executor memory, and the rollup holds what the
    raw table holds.
    """
    landed = spark.read.schema(STAMPED_TRIP_SCHEMA).parquet(batch_path(raw, batch_ms))
    write_batch(batch_rollup(landed, decimals=decimals), rollup, batch_ms)


def query_id(spark: SparkSession) -> str:
    """The id of the running stream, which its checkpoint keeps from start to start."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def _land_batch(
    spark: SparkSession,
    raw: str,
    rollup: str,
    rejects: str | None,
    decimals: Decimals,
    preview: int,
    named: Sequence[str],
    ledger: str | None,
) -> Callable[[DataFrame, int], None]:
    def land(batch: DataFrame, batch_id: int) -> None:
        head = batch.select(partition_value(STAMP).alias(PARTITION)).first()
        if head is None:
            return
        batch_ms, places, counted = head[PARTITION], (raw, rollup, rejects), Observation()
        if ledger is not None:
            ingest = query_id(spark)
            if is_landed(spark, ledger, ingest, batch_id):
                return
            places = tuple(p and ingest_path(p, ingest, batch_id) for p in places)
        to_raw, to_rollup, to_rejects = places
        if to_rejects is None:
            if ledger is not None:
                batch = batch.observe(counted, F.count(F.lit(1)).alias("n"))
            write_batch(batch, to_raw, batch_ms)
            n_refused = 0
        else:
            counts = F.count(F.lit(1)).alias("n"), F.count(REASON).alias("n_refused")
            write_batch(accepted_trips(batch.observe(counted, *counts)), to_raw, batch_ms)
            n_refused = counted.get["n_refused"]
            # The source is read a second time only by batches with faulty lines.
            if n_refused:
                write_batch(rejected_lines(batch), to_rejects, batch_ms)
        roll_up_batch(spark, to_raw, to_rollup, batch_ms, decimals)
        if ledger is not None:
            n_rows = counted.get["n"] - n_refused
            record_batch(spark, ledger, ingest, batch_id, batch_ms, n_rows, n_refused)
        for table in named:
            add_batch(spark, table, batch_ms)
        if preview:
            show(spark.read.parquet(batch_path(to_raw, batch_ms)), preview)
            show(spark.read.parquet(batch_path(to_rollup, batch_ms)), preview)

    return land


def start_ingest(
    messages: DataFrame,
    raw: str,
    rollup: str,
    checkpoint: str,
    *,
    form: str = CSV,
    mode: str = STRICT,
    rejects: str | None = None,
    trigger: dict | None = None,
    decimals: Decimals = None,
    preview: int = 0,
    named: Sequence[str] = (),
    ledger: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start the ingest; ``awaitTermination`` of the result waits for its end.

    ``messages`` is a stream with a ``value`` column, of CSV lines or with ``form="json"``
    of JSON documents. In strict mode a faulty message fails the query; in quarantine mode
    it goes to the ``rejects`` table with the reason. ``trigger`` defaults to a micro-batch
    a minute. ``preview`` rows of each batch and of its rollup are printed. ``named`` are
    tables defined over ``raw`` or ``rollup`` that each batch is made known to; read by
    name, they list the partitions a query needs instead of the whole directory. A pair
    of tables takes one ingest at a time, since two could share a stamp.

    With a ``ledger``, a path, tables take any number of ingests at once. Each batch has a
    directory of its own, by ingest and batch number, and counts once the ledger has an entry
    for it, which is written last; see :mod:`triprollup.sinks.ledger`.
    """
    if ledger is not None and named:
        raise ValueError("tables of several ingests are not known to the catalog by batch")
    if (mode == QUARANTINE) != (rejects is not None):
        raise ValueError("a rejects path goes with quarantine mode, and only with it")
    writer = (
        stamped_messages(messages, mode, form)
        .writeStream.foreachBatch(
            _land_batch(
                messages.sparkSession, raw, rollup, rejects, decimals, preview, named, ledger
            )
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_MINUTE))
    )
    return (writer.queryName(name) if name else writer).start()


def run_ingest(messages: DataFrame, raw: str, rollup: str, checkpoint: str, **options) -> None:
    """Ingest what the source holds now and return; a failure is raised."""
    query = start_ingest(
        messages, raw, rollup, checkpoint, trigger=UNTIL_CAUGHT_UP, **options
    )
    query.awaitTermination()
