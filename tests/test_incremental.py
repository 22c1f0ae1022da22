"""The stored report against the plain one, over batches that come, come again and go."""

import random
import re
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import line
from triprollup.operators.decode import decode_trips
from triprollup.plans import incremental, reports
from triprollup.schemas import PARTITION, STAMP
from triprollup.sinks import commits
from triprollup.sinks.tables import write_batch
from triprollup.sources.tables import raw_table


@pytest.fixture
def table(spark, lines_of, tmp_path):
    """A raw table whose batches are written, and written again, from a few lines."""
    path = str(tmp_path / "raw")

    def write(batch, *lines):
        rows = decode_trips(lines_of(*lines)).withColumn(STAMP, F.lit("2016-01-01").cast("timestamp"))
        write_batch(rows, path, batch)

    return path, write


def _plain(spark, path, decimals=2):
    return list(map(tuple, reports.report_raw(raw_table(spark, path), decimals).collect()))


def _round(spark, path, state, decimals=2):
    return list(map(tuple, incremental.report_incremental(spark, path, state, decimals).collect()))


def test_batches_come_late_again_and_go(spark, table, tmp_path):
    path, write = table
    state = str(tmp_path / "state")
    write(10, line(), line(vendor_id="1"))
    write(20, line(total_amount="1.1"))
    assert _round(spark, path, state) == _plain(spark, path)
    write(5, line(payment_type="9", total_amount="0.07"))  # late
    write(20, line(vendor_id="7"))  # replayed, one group gone
    assert _round(spark, path, state) == _plain(spark, path)
    write(30, line(vendor_id="1", total_amount="-3.3"))
    shutil.rmtree(f"{path}/{PARTITION}=10")
    assert _round(spark, path, state) == _plain(spark, path)
    assert [r[0] for r in _plain(spark, path)] == ["1", "2", "7"]


def test_a_round_reads_only_what_changed(spark, table, tmp_path, monkeypatch):
    path, write = table
    state, plans = str(tmp_path / "state"), []
    read = incremental.StoredReport._read

    def watched(self, raw, changed):
        rows = read(self, raw, changed)
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return rows

    monkeypatch.setattr(incremental.StoredReport, "_read", watched)
    for batch in range(1, 9):
        write(batch, line(total_amount=f"{batch}.5"))
    _round(spark, path, state)
    before = spark.read.parquet(f"{state}/partials").count()
    write(3, line(vendor_id="4"))
    write(9, line())
    assert _round(spark, path, state) == _plain(spark, path)
    named = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plans[-1]).group(1)
    assert re.search(r"batch_ms#\d+L? IN \((3,9|9,3)\)", named)
    assert "ReadSchema: struct<vendor_id:string,payment_type:string,total_amount:double>" in plans[-1]
    assert spark.read.parquet(f"{state}/partials").count() == before + 2
    # Nothing came: nothing is read or written.
    rounds = spark.read.parquet(f"{state}/rounds").count()
    assert _round(spark, path, state) == _plain(spark, path)
    assert len(plans) == 2 and spark.read.parquet(f"{state}/rounds").count() == rounds


def test_many_changed_batches_are_read_by_their_range(spark, table, tmp_path, monkeypatch):
    path, write = table
    monkeypatch.setattr(incremental, "NAMED_BATCHES", 1)
    state = str(tmp_path / "state")
    for batch in (1, 2, 3, 4):
        write(batch, line(vendor_id=str(batch % 2)))
    assert _round(spark, path, state) == _plain(spark, path)
    write(2, line(total_amount="7"))
    write(4, line(total_amount="8"))
    assert _round(spark, path, state) == _plain(spark, path)


@pytest.mark.parametrize("decimals", [2, None])
def test_sums_that_cannot_be_taken_back(spark, table, tmp_path, decimals):
    path, write = table
    state = str(tmp_path / "state")
    write(1, line(total_amount="Infinity"), line(vendor_id="1", total_amount="NaN"))
    write(2, line(total_amount="0.1"), line(vendor_id="1", total_amount="0.2"))
    assert repr(_round(spark, path, state, decimals)) == repr(_plain(spark, path, decimals))
    write(1, line(total_amount="0.3"), line(vendor_id="1", total_amount="0.4"))
    found, plain = _round(spark, path, state, decimals), _plain(spark, path, decimals)
    assert [r[:3] for r in found] == [r[:3] for r in plain]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in plain], rel=1e-12)


def test_rounds_over_several_epochs(spark, table, tmp_path, monkeypatch):
    """State is folded into one whole round, and what no round reads any more is removed."""
    path, write = table
    for module in (commits, incremental):
        monkeypatch.setattr(module, "EPOCH", 3)
    state, rng = str(tmp_path / "state"), random.Random(4)
    for _ in range(8):
        batch, vendor = rng.randrange(5), str(rng.randrange(3))
        write(batch, line(vendor_id=vendor, total_amount=f"{rng.randrange(900) / 100}"), line())
        assert _round(spark, path, state) == _plain(spark, path)
    assert incremental.StoredReport(spark, state, 2).remove_old() > 3
    write(2, line(vendor_id="9"))
    assert _round(spark, path, state) == _plain(spark, path)


@pytest.mark.parametrize("moment", ["_read", "_partials", "_must_add_again", "commit"])
def test_a_round_that_is_cut_off(spark, table, tmp_path, monkeypatch, moment):
    path, write = table
    state = str(tmp_path / "state")
    write(1, line())
    before = _round(spark, path, state)
    write(1, line(total_amount="5"))
    write(2, line())

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        if moment == "commit":
            patch.setattr(incremental, "add_commit", die)
        else:
            patch.setattr(incremental.StoredReport, moment, die)
        with pytest.raises(KeyboardInterrupt):
            _round(spark, path, state)
    stored = incremental.StoredReport(spark, state, 2)
    assert list(map(tuple, stored.totals().collect())) == before
    assert _round(spark, path, state) == _plain(spark, path)
    assert stored.remove_old() >= 1 and _round(spark, path, state) == _plain(spark, path)


def test_two_rounds_at_once(spark, table, tmp_path, monkeypatch):
    """Another round commits first: this one is repeated upon it and nothing counts twice."""
    path, write = table
    state = str(tmp_path / "state")
    write(1, line())
    _round(spark, path, state)
    write(2, line(vendor_id="1"))
    real, seen = incremental.add_commit, []

    def late(*args):
        if not seen:
            seen.append(1)
            _round(spark, path, state)
        return real(*args)

    monkeypatch.setattr(incremental, "add_commit", late)
    assert _round(spark, path, state) == _plain(spark, path)


def test_an_empty_table(spark, table, tmp_path):
    path, write = table
    write(1, line())
    shutil.rmtree(f"{path}/{PARTITION}=1")
    state = str(tmp_path / "state")
    assert _round(spark, path, state) == [] == _round(spark, path, state)
    write(2, line())
    assert _round(spark, path, state) == _plain(spark, path)
