"""Streamed trip records: decode, stamp, store, roll up, report, reconcile."""

from triprollup.operators.decode import decode_trips, encode_json, encode_lines
from triprollup.operators.reconcile import reconcile
from triprollup.operators.rollup import batch_rollup, reaggregate
from triprollup.operators.drilldown import drill_down
from triprollup.plans.incremental import report_incremental
from triprollup.plans.reports import (
    reconcile_reports,
    report_raw,
    report_rollup,
    timed_reports,
)
from triprollup.sinks.keyed import define_keyed, open_keyed
from triprollup.sinks.ledger import landed_batches, landed_table
from triprollup.sinks.retention import reading, remove_compacted
from triprollup.sinks.tables import compact, upsert_rollup
from triprollup.sources.evolved import evolved_table
from triprollup.sources.inferred import csv_inferred
from triprollup.sources.messages import kafka_messages, kafka_stream, line_stream
from triprollup.sources.offsets import kafka_range_options, offset_faults, offset_range_read
from triprollup.sources.scratch import scratch_run
from triprollup.sources.tables import raw_table, reject_table, rollup_table, with_history
from triprollup.streaming.ingest import run_ingest, start_ingest
from triprollup.streaming.progress import batch_progress, recorded

__all__ = [
    "batch_progress",
    "batch_rollup",
    "compact",
    "csv_inferred",
    "decode_trips",
    "define_keyed",
    "drill_down",
    "encode_json",
    "encode_lines",
    "evolved_table",
    "kafka_messages",
    "kafka_range_options",
    "kafka_stream",
    "landed_batches",
    "landed_table",
    "line_stream",
    "offset_faults",
    "offset_range_read",
    "open_keyed",
    "raw_table",
    "reading",
    "reaggregate",
    "reconcile",
    "reconcile_reports",
    "recorded",
    "reject_table",
    "remove_compacted",
    "report_incremental",
    "report_raw",
    "report_rollup",
    "rollup_table",
    "run_ingest",
    "scratch_run",
    "start_ingest",
    "timed_reports",
    "upsert_rollup",
    "with_history",
]
