"""Times the headline queries and prints one JSON line.

Tables come from ``$BENCH_SF_DIR``, cores from ``$BENCH_CPUS``. A query is run once to
warm up and then ``$BENCH_RUNS`` times; the best run counts. ``report_rollup`` and
``reconcile`` read a rollup stored beforehand, as a user would.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from triprollup.operators.decode import decode_trips, encode_json, encode_lines
from triprollup.operators.rollup import batch_rollup, reaggregate
from triprollup.plans import reports
from triprollup.plans.lineitem_trips import BATCH, BATCH_KEYS, trips, write_feed
from triprollup.schemas import DECIMALS, GROUP_KEYS
from triprollup.sinks.tables import write_partitions
from triprollup.sources.messages import line_messages, line_stream
from triprollup.sources.scratch import scratch_path
from triprollup.sources.tables import parquet_table
from triprollup.streaming.ingest import run_ingest

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
MICRO_BATCHES = 4
ROW_RATES = ("csv_decode", "json_decode", "stream_one_batch", "stream_micro_batches")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("triprollup-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best_of(action, runs: int = RUNS) -> float:
    action()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return min(times)


def main() -> None:
    spark = session()
    source = trips(spark, SF_DIR)
    rows = source.count()

    stored = scratch_path(spark, "bench-rollup")
    write_partitions(batch_rollup(source, BATCH_KEYS, decimals=DECIMALS), stored, BATCH)
    rollup = parquet_table(spark, stored)

    def opened():
        """The stored rollup, opened anew with its known schema."""
        return spark.read.schema(rollup.schema).parquet(stored)

    feed = scratch_path(spark, "bench-feed")
    size = write_feed(encode_lines(source, keep=[BATCH]), feed, by=BATCH)
    documents = scratch_path(spark, "bench-documents")
    write_feed(encode_json(source, keep=[BATCH]), documents, by=BATCH)

    def ingest(limits: dict) -> None:
        run_ingest(
            line_stream(spark, feed, **limits),
            *(scratch_path(spark, f"bench-{name}") for name in ("raw", "rollup", "state")),
            decimals=DECIMALS,
        )

    actions = {
        "report_raw": lambda: run(reports.report_raw(source, DECIMALS)),
        "report_rollup": lambda: run(reports.report_rollup(opened(), DECIMALS)),
        "rollup_full": lambda: run(batch_rollup(source, BATCH_KEYS, decimals=DECIMALS)),
        "reconcile": lambda: run(reports.reconcile_reports(source, opened(), DECIMALS)),
        "rollup_from_rollup": lambda: run(
            reaggregate(opened(), GROUP_KEYS, decimals=DECIMALS)
        ),
        "csv_decode": lambda: run(decode_trips(line_messages(spark, feed))),
        "json_decode": lambda: run(decode_trips(line_messages(spark, documents), form="json")),
        "stream_one_batch": lambda: ingest({}),
        "stream_micro_batches": lambda: ingest(
            {"maxBytesPerTrigger": max(1, size // MICRO_BATCHES)}
        ),
    }
    seconds = {name: round(best_of(action), 3) for name, action in actions.items()}
    print(
        json.dumps(
            {
                "metric": "sum of best query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "rows": rows,
                "cpus": CPUS,
                "rows_per_sec": {
                    name: round(rows / seconds[name])
                    for name in ROW_RATES
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
