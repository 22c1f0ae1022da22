import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import FIELDS, line
from triprollup.functions.time import format_stamp, load_date
from triprollup.operators.decode import decode_trips
from triprollup.operators.rollup import batch_rollup
from triprollup.plans import reports
from triprollup.schemas import (
    GROUP_KEYS,
    PARTITION,
    ROLLUP_SCHEMA,
    ROLLUP_TABLE_SCHEMA,
    STAMP,
    TRIP_COLUMNS,
)
from triprollup.sinks import retention
from triprollup.sinks import tables as sink
from triprollup.sources import tables as source
from triprollup.sources.messages import (
    kafka_messages,
    kafka_options,
    kafka_stream,
    project_key_value,
    project_value,
)
from triprollup.sources.scratch import scratch_path, scratch_run


@pytest.fixture
def trips(lines_of):
    return decode_trips(
        lines_of(
            line(), line(), line(vendor_id="1", total_amount="3.3"), line(payment_type="1")
        )
    )


def _stamped(trips, text):
    return trips.withColumn(STAMP, F.lit(text).cast("timestamp"))


def _contents(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_batch_written_twice_lands_once(spark, trips, tmp_path):
    path = str(tmp_path / "raw")
    for batch in (1, 2, 2):
        sink.write_batch(_stamped(trips, "2016-01-01"), path, batch)
    table = source.raw_table(spark, path)
    assert table.count() == 8
    assert sorted(r[0] for r in table.select(PARTITION).distinct().collect()) == [1, 2]


def test_append_stamped_replaces_only_its_batches(spark, trips, tmp_path):
    path = str(tmp_path / "raw")
    both = _stamped(trips, "2016-01-01").unionByName(_stamped(trips, "2016-01-02"))
    sink.append_stamped(both, path)
    sink.append_stamped(_stamped(trips.limit(1), "2016-01-02"), path)
    table = source.raw_table(spark, path)
    assert [tuple(r) for r in table.groupBy(STAMP).count().orderBy(STAMP).select(
        F.date_format(STAMP, "dd"), "count").collect()] == [("01", 4), ("02", 1)]
    one_day = table.filter(F.col(PARTITION) == 1451606400000)
    assert one_day.count() == 4
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_ms" in plan


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """Two thirds of the rows in one partition must not end in one task."""
    path, size = str(tmp_path / "hot"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = spark.range(300_000, numPartitions=8).select(
        F.when(F.col("id") % 3 < 2, 1).otherwise(F.col("id") % 50).cast("bigint").alias(PARTITION),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    spark.conf.set(size, "1m")
    try:
        sink.write_partitions(rows, path)
    finally:
        spark.conf.unset(size)
    assert len(glob.glob(f"{path}/{PARTITION}=1/*.parquet")) > 4
    # 8 tasks writing 50 partitions as they come would make 400 files.
    assert len(glob.glob(f"{path}/*/*.parquet")) < 200
    assert spark.read.parquet(path).count() == 300_000


def test_rollup_schema_is_what_the_rollup_gives(trips):
    rollup = batch_rollup(_stamped(trips, "2016-01-01"))
    given = [(f.name, f.dataType) for f in rollup.schema]
    assert given == [(f.name, f.dataType) for f in ROLLUP_SCHEMA]
    assert len(ROLLUP_SCHEMA) == 19


def _rollup(trips, stamp):
    return batch_rollup(_stamped(trips, stamp)).withColumn(
        PARTITION, F.unix_millis(F.col(STAMP))
    )


def test_upsert(spark, trips, tmp_path):
    path = str(tmp_path / "rollup")
    sink.upsert_rollup(_rollup(trips, "2016-01-01"), path)
    sink.upsert_rollup(_rollup(trips, "2016-01-02"), path)
    before = set(glob.glob(f"{path}/{PARTITION}=1451606400000/*.parquet"))
    only_one = trips.filter(F.col("vendor_id") == "1").withColumn("total_amount", F.lit(99.0))
    sink.upsert_rollup(_rollup(only_one, "2016-01-02"), path)
    stored = source.rollup_table(spark, path)
    got = {
        (str(r[STAMP])[:10], r["vendor_id"], r["payment_type"]): (
            r["sum_total_amount"],
            r["count_trips"],
        )
        for r in stored.collect()
    }
    assert got == {
        ("2016-01-01", "2", "2"): (59.0, 2), ("2016-01-01", "1", "2"): (3.3, 1),
        ("2016-01-01", "2", "1"): (29.5, 1), ("2016-01-02", "2", "2"): (59.0, 2),
        ("2016-01-02", "1", "2"): (99.0, 1), ("2016-01-02", "2", "1"): (29.5, 1),
    }
    untouched = set(glob.glob(f"{path}/{PARTITION}=1451606400000/*.parquet"))
    assert untouched == before


def test_upsert_of_nothing(spark, trips, tmp_path):
    path = str(tmp_path / "rollup")
    sink.upsert_rollup(_rollup(trips, "2016-01-01"), path)
    before = _contents(source.rollup_table(spark, path))
    sink.upsert_rollup(_rollup(trips.filter(F.lit(False)), "2016-01-01"), path)
    assert _contents(source.rollup_table(spark, path)) == before


def test_failing_load_leaves_the_table(spark, trips, lines_of, tmp_path):
    path = str(tmp_path / "rollup")
    sink.upsert_rollup(_rollup(trips, "2016-01-01"), path)
    before = _contents(source.rollup_table(spark, path))
    broken = decode_trips(lines_of(line(), "x"))
    with pytest.raises(Exception, match="refused trip line"):
        sink.upsert_rollup(_rollup(broken, "2016-01-01"), path)
    assert _contents(source.rollup_table(spark, path)) == before


STAMPS = ("01 00:00:00", "01 00:01:00", "02 23:59:00", "03 00:01:00", "04 00:00:00")


def _live_and_history(spark, trips, tmp_path):
    path, history = str(tmp_path / "rollup"), str(tmp_path / "history")
    for stamp in STAMPS:
        sink.write_partitions(_rollup(trips, f"2016-01-{stamp}"), path)
    return source.rollup_table(spark, path), path, history


def test_compaction_keeps_the_reports(spark, trips, tmp_path):
    live, _, history = _live_and_history(spark, trips, tmp_path)
    assert _contents(source.with_history(live, history)) == _contents(live)
    whole = reports.report_rollup(live).collect()
    for day, joined in (("01", False), ("01", True), ("02", False), ("03", True)):
        sink.compact(live, history, f"2016-01-{day}", join_files=joined)
        both = source.with_history(live, history)
        assert both.columns == live.columns
        assert _contents(both) == _contents(live)
        assert reports.report_rollup(both).collect() == whole
    assert source.history_batches(spark, history).count() == 4


def test_compaction_again_after_pruning_loses_nothing(spark, trips, tmp_path):
    live, _, history = _live_and_history(spark, trips, tmp_path)
    before = _contents(live)
    sink.compact(live, history, "2016-01-01")
    pruned = live.filter(F.col(STAMP) >= "2016-01-02 00:00:00")
    for _ in range(2):
        sink.compact(pruned, history, "2016-01-01")
        assert _contents(source.with_history(pruned, history)) == before


def test_a_batch_that_comes_after_compaction_counts_once(spark, trips, tmp_path):
    live, path, history = _live_and_history(spark, trips, tmp_path)
    sink.compact(live, history, "2016-01-01")
    for stamp in ("01 00:00:00", "01 12:00:00"):  # replayed, and late
        sink.write_partitions(_rollup(trips, f"2016-01-{stamp}"), path)
    live = source.rollup_table(spark, path)
    assert _contents(source.with_history(live, history)) == _contents(live)
    sink.compact(live, history, "2016-01-01")
    assert source.history_batches(spark, history).count() == 3
    assert _contents(source.with_history(live, history)) == _contents(live)


def test_compaction_cuts_days_in_utc(spark, trips, tmp_path):
    live, _, history = _live_and_history(spark, trips, tmp_path)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        sink.compact(live, history, "2016-01-01")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert source.history_batches(spark, history).count() == 2
    assert _contents(source.with_history(live, history)) == _contents(live)


def test_rows_of_a_compaction_that_was_cut_off_do_not_count(spark, trips, tmp_path):
    live, _, history = _live_and_history(spark, trips, tmp_path)
    sink.compact(live, history, "2016-01-01")
    live.write.parquet(f"{source.history_rows(history)}/{source.RUN}=cut-off")
    assert _contents(source.with_history(live, history)) == _contents(live)


def test_removal_of_compacted_batches(spark, trips, tmp_path):
    live, path, history = _live_and_history(spark, trips, tmp_path)
    before = _contents(live)
    assert retention.remove_compacted(spark, path, history, 0) == []
    sink.compact(live, history, "2016-01-01")
    assert retention.remove_compacted(spark, path, history) == []  # too young
    # Copied rows that were never listed do not count.
    live.filter(F.col(STAMP) > "2016-01-02").write.parquet(
        f"{source.history_rows(history)}/{source.RUN}=cut-off"
    )
    assert len(retention.remove_compacted(spark, path, history, 0)) == 2
    opened = source.rollup_table(spark, path)
    assert opened.select(PARTITION).distinct().count() == 3
    assert _contents(source.with_history(opened, history)) == before
    # Compacted again after the removal, and a late replay: nothing is lost or doubled.
    sink.compact(opened, history, "2016-01-01")
    sink.write_partitions(_rollup(trips, "2016-01-01 00:00:00"), path)
    opened = source.rollup_table(spark, path)
    assert _contents(source.with_history(opened, history)) == before
    assert len(retention.remove_compacted(spark, path, history, 0)) == 1
    assert _contents(source.with_history(source.rollup_table(spark, path), history)) == before


def test_a_removal_that_is_cut_off(spark, trips, tmp_path, monkeypatch):
    live, path, history = _live_and_history(spark, trips, tmp_path)
    before = _contents(live)
    sink.compact(live, history, "2016-01-01")
    real, seen = retention.remove, []

    def die(session, where):
        if "marks" not in where:
            seen.append(where)
        if len(seen) == 2:
            raise KeyboardInterrupt
        return real(session, where)

    monkeypatch.setattr(retention, "remove", die)
    with pytest.raises(KeyboardInterrupt):
        retention.remove_compacted(spark, path, history, 0)
    monkeypatch.undo()
    both = source.with_history(source.rollup_table(spark, path), history)
    assert _contents(both) == before
    monkeypatch.setattr(retention, "REMOVE_SECONDS", 0.0)
    assert _contents(both) == before


def test_batches_stay_while_a_report_reads(spark, trips, tmp_path, monkeypatch):
    live, path, history = _live_and_history(spark, trips, tmp_path)
    sink.compact(live, history, "2016-01-01")
    with retention.reading(spark, history):
        opened = source.with_history(source.rollup_table(spark, path), history)
        before = _contents(opened)
        assert retention.remove_compacted(spark, path, history, 0) == []
        assert _contents(opened) == before
    # A reader that died is passed over once its mark has run out.
    mark = retention._mark(spark, history, retention.READING, -1)
    mark.__enter__()
    # A removal under way makes readers wait.
    with retention._mark(spark, history, retention.REMOVING, 60):
        with pytest.raises(TimeoutError):
            with retention.reading(spark, history, wait=0.2):
                pass
    assert len(retention.remove_compacted(spark, path, history, 0)) == 2
    with retention.reading(spark, history):
        assert _contents(source.with_history(source.rollup_table(spark, path), history)) == before


def test_named_table(spark, trips, tmp_path):
    path = str(tmp_path / "named")
    for _ in range(2):
        sink.define_table(spark, "named_rollup_test", path)
    assert spark.table("named_rollup_test").count() == 0
    sink.write_batch(batch_rollup(_stamped(trips, "2016-01-01")), path, 7)
    sink.discover_partitions(spark, "named_rollup_test")
    table = spark.table("named_rollup_test")
    assert table.count() == 3
    assert set(table.columns) == set(ROLLUP_TABLE_SCHEMA.fieldNames())
    spark.sql("drop table named_rollup_test")


def test_namespace(spark, tmp_path):
    for _ in range(2):
        sink.define_namespace(spark, "trips_test", str(tmp_path / "space"))
    sink.define_table(spark, "trips_test.rollup", str(tmp_path / "rollup"))
    assert spark.table("trips_test.rollup").columns[-1] == PARTITION
    spark.sql("drop database trips_test cascade")


def test_overwrite_table(spark, tmp_path):
    path = str(tmp_path / "plain")
    for n in (5, 3):
        sink.overwrite_table(spark.range(n), "overwrite_test", path)
    assert spark.table("overwrite_test").count() == 3
    spark.sql("drop table overwrite_test")


def test_refresh_sees_appended_files(spark, trips, tmp_path):
    path = str(tmp_path / "raw")
    sink.append_trips(trips, path)
    view = reports.register(source.parquet_table(spark, path), "refresh_test")
    count = f"select count(*) from {view}"
    assert spark.sql(count).first()[0] == 4
    # Written behind the session's back, as another program would.
    sink.append_trips(trips, str(tmp_path / "other"))
    for i, file in enumerate(glob.glob(str(tmp_path / "other" / "*.parquet"))):
        with open(file, "rb") as a, open(f"{path}/more-{i}.parquet", "wb") as b:
            b.write(a.read())
    assert spark.sql(count).first()[0] == 4
    reports.refresh(spark, view)
    assert spark.sql(count).first()[0] == 8


def test_merged_schema(spark, trips, tmp_path):
    path = str(tmp_path / "merged")
    sink.append_trips(trips, path)
    sink.append_trips(_stamped(trips, "2016-01-01"), path)
    merged = source.merged_schema_table(spark, path)
    assert merged.agg(F.count("*"), F.count(STAMP)).first()[:] == (8, 4)


def test_csv_with_header(spark, trips, tmp_path):
    path = str(tmp_path / "csv")
    trips.write.option("header", True).csv(path)
    assert _contents(source.csv_file(spark, path)) == _contents(trips)


@pytest.mark.parametrize("damage", ["x,", "1,2,3"])
def test_csv_with_faulty_lines_fails(spark, trips, tmp_path, damage):
    header, good = ",".join(TRIP_COLUMNS), line()
    fields = good.split(",")
    faulty = damage if "2" in damage else ",".join([*fields[:3], "two", *fields[4:]])
    (tmp_path / "trips.csv").write_text(f"{header}\n{good}\n{faulty}\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        source.csv_file(spark, str(tmp_path)).collect()


def test_envelopes(spark):
    df = spark.createDataFrame([(b"k", b"v", 1)], "key binary, value binary, offset bigint")
    assert project_value(df).collect() == [("v",)]
    assert project_key_value(df).collect() == [("k", "v")]


def test_kafka_options():
    assert kafka_options("h:9092", "trips", startingOffsets="earliest") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "trips",
        "startingOffsets": "earliest",
    }


def test_kafka_asks_for_its_package(spark):
    for read in (kafka_stream, kafka_messages):
        with pytest.raises(Exception, match="(?i)kafka"):
            read(spark, "h:9092", "trips")


def test_stamp_text_and_day(spark):
    df = spark.sql("select timestamp'2017-07-19 09:55:42' as ts")
    row = df.select(format_stamp("ts"), load_date("ts").cast("string")).first()
    assert row[:] == ("2017-07-19 09:55:42+0000", "2017-07-19")


def test_reports_agree_and_are_timed(spark, trips, capsys):
    rollup = batch_rollup(_stamped(trips, "2016-01-01"), decimals=2)
    raw = reports.report_raw(trips, 2).collect()
    assert [tuple(r) for r in raw] == [("1", "2", 1, 3.3), ("2", "1", 1, 29.5), ("2", "2", 2, 59.0)]
    assert reports.report_rollup(rollup, 2).collect() == raw
    assert reports.report_raw(trips).columns == [*GROUP_KEYS, *reports.REPORT_VALUES]
    assert all(r["match"] for r in reports.reconcile_reports(trips, rollup, 2).collect())
    plain = batch_rollup(_stamped(trips, "2016-01-01"))
    assert all(r["match"] for r in reports.reconcile_reports(trips, plain).collect())
    timed = reports.timed_reports(trips, rollup, rounds=2).collect()
    assert [(r["round"], r["report"]) for r in timed] == [
        (1, "raw"), (1, "rollup"), (2, "raw"), (2, "rollup"),
    ]
    assert all(r["seconds"] > 0 and r["started_at"] <= r["ended_at"] for r in timed)
    assert timed[0]["seconds_saved"] == 0
    reports.print_report(reports.report_raw(trips))
    assert capsys.readouterr().out.splitlines()[0] == "1\t2\t1\t3.3"


def test_raw_report_reads_three_columns(spark, trips, tmp_path):
    path = str(tmp_path / "raw")
    sink.write_batch(_stamped(trips, "2016-01-01"), path, 1)
    report = reports.report_raw(source.raw_table(spark, path))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<vendor_id:string,payment_type:string,total_amount:double>" in plan


def test_scratch_paths_differ_and_lie_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root)


def test_intermediate_tables_of_a_run_are_removed(spark, tmp_path):
    with scratch_run(spark) as outer:
        first = scratch_path(spark, "a")
        spark.range(3).write.parquet(first)
        with scratch_run(spark) as inner:
            second = scratch_path(spark, "b")
            spark.range(3).write.parquet(second)
            assert inner.startswith(outer) and second.startswith(inner)
        assert not os.path.exists(inner) and os.path.exists(first) and first.startswith(outer)
        result = str(tmp_path / "result")
        spark.read.parquet(first).write.parquet(result)
    assert not os.path.exists(outer) and spark.read.parquet(result).count() == 3
    assert not scratch_path(spark, "c").startswith(outer)
    with pytest.raises(RuntimeError):
        with scratch_run(spark) as failed:
            spark.range(3).write.parquet(scratch_path(spark, "d"))
            raise RuntimeError
    assert not os.path.exists(failed)


class _Session:
    def __init__(self, **settings):
        self.conf = {name.replace("_", "."): value for name, value in settings.items()}


def test_scratch_needs_a_shared_folder():
    shared = _Session(spark_master="yarn", spark_checkpoint_dir="hdfs:///shared/")
    assert scratch_path(shared, "x").startswith("hdfs:///shared/triprollup/x-")
    for master in ("yarn", "local[4]"):
        with pytest.raises(ValueError):
            scratch_path(_Session(spark_master=master), "x")


def test_fixture_has_every_field():
    assert len(FIELDS) == len(TRIP_COLUMNS) == 19 and set(GROUP_KEYS) < set(TRIP_COLUMNS)
