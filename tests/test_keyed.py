"""Keyed tables: the key and the order of writes are guarded, and versions change at once."""

import os
import random
import subprocess
import sys

import pytest

from triprollup.sinks import commits, keyed
from triprollup.sinks.commits import OtherWriter

SCHEMA = "batch bigint, k string, v double, seq bigint"


@pytest.fixture
def made(spark, tmp_path):
    """A keyed table of its own, with or without an order of writes."""

    def define(name="table", order=("seq",)):
        return keyed.define_keyed(spark, str(tmp_path / name), _schema(spark), ["k"], "batch", order)

    return define


def _schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def _load(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA).repartition(3)


def _rows(table, **limits):
    return sorted(map(tuple, table.rows(**limits).collect()), key=repr)


def test_newest_row_stays(spark, made):
    table = made()
    assert _rows(table) == [] and table.version() == 0
    table.upsert(_load(spark, (1, "a", 1.0, 5), (1, "b", 1.0, 5), (2, "a", 1.0, 5)))
    # Older than the stored one, as new as it, newer, and a new key.
    table.upsert(_load(spark, (1, "a", 2.0, 4), (1, "b", 2.0, 5), (2, "a", 2.0, 6), (2, None, 2.0, None)))
    assert _rows(table) == [(1, "a", 1.0, 5), (1, "b", 2.0, 5), (2, "a", 2.0, 6), (2, None, 2.0, None)]
    assert table.version() == 2


def test_a_key_given_several_times_in_a_load(spark, made):
    table = made()
    rows = [(1, "a", float(i), i) for i in range(40)] + [(1, "a", 39.0, 39)]
    random.Random(1).shuffle(rows)
    table.upsert(_load(spark, *rows))
    assert _rows(table) == [(1, "a", 39.0, 39)]
    with pytest.raises(Exception, match="key given twice.*1, a"):
        table.upsert(_load(spark, (1, "a", 1.0, 50), (1, "a", 2.0, 50), (1, "b", 1.0, 1)))
    # What is not the newest needs no order.
    table.upsert(_load(spark, (1, "a", 1.0, 50), (1, "a", 2.0, 50), (1, "a", 3.0, 51)))
    assert _rows(table) == [(1, "a", 3.0, 51)]


def test_without_an_order_a_key_is_given_once(spark, made):
    table = made(order=())
    table.upsert(_load(spark, (1, "a", 1.0, 9), (1, "b", 1.0, 9)))
    table.upsert(_load(spark, (1, "a", 2.0, 1), (1, "a", 2.0, 1)))  # the same row twice
    with pytest.raises(Exception, match="key given twice"):
        table.upsert(_load(spark, (1, "b", 2.0, 1), (1, "b", 3.0, 2)))
    assert _rows(table) == [(1, "a", 2.0, 1), (1, "b", 1.0, 9)] and table.version() == 2


def test_the_definition_is_kept(spark, made, tmp_path):
    made()
    assert keyed.open_keyed(spark, made().path) == made()
    for wrong in (["v"], ["k", "v"]):
        with pytest.raises(ValueError, match="defined otherwise"):
            keyed.define_keyed(spark, made().path, _schema(spark), wrong, "batch", ["seq"])
    for keys, partition, order in ((["x"], "batch", ()), ([], "batch", ()), (["k"], "v", ()), (["k"], "batch", ["x"])):
        with pytest.raises(ValueError):
            keyed.define_keyed(spark, str(tmp_path / "other"), _schema(spark), keys, partition, order)
    with pytest.raises(ValueError, match="no keyed table"):
        keyed.open_keyed(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="must have the columns"):
        made().upsert(spark.createDataFrame([(1, "a")], "batch bigint, k string"))
    with pytest.raises(Exception, match="a row without batch"):
        made().upsert(_load(spark, (None, "a", 1.0, 1)))


def test_only_touched_partitions_are_copied(spark, made):
    table = made()
    table.upsert(_load(spark, *((p, "a", 1.0, 1) for p in range(6))))
    table.upsert(_load(spark, (2, "b", 1.0, 1)))
    runs = {r["part"]: r["run"] for r in table.listing().collect()}
    assert len(runs) == 6 and runs[2] != runs[1] and len({runs[p] for p in (0, 1, 3, 4, 5)}) == 1
    assert os.listdir(f"{table.path}/rows/run={runs[2]}").count("batch=2") == 1
    assert _rows(table, low=2, high=3) == [(2, "a", 1.0, 1), (2, "b", 1.0, 1), (3, "a", 1.0, 1)]
    assert len(table.rows(low=2, high=3).inputFiles()) == 2
    table.upsert(_load(spark))
    assert len(_rows(table)) == 7


@pytest.mark.parametrize("moment", ["_staged", "_write_copies", "_commit"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_writer_that_is_lost(spark, made, monkeypatch, moment, when):
    """Killed before or after any of its writes: the table is the old or the new one."""
    table = made()
    table.upsert(_load(spark, (1, "a", 1.0, 1), (2, "a", 1.0, 1)))
    before = _rows(table)
    real = getattr(keyed.KeyedTable, moment)

    def die(*args):
        if when == "after":
            real(*args)
        raise KeyboardInterrupt

    load = _load(spark, (1, "a", 2.0, 2), (2, "b", 2.0, 2))
    with monkeypatch.context() as patch:
        patch.setattr(keyed.KeyedTable, moment, die)
        with pytest.raises(KeyboardInterrupt):
            table.upsert(load)
    after = [(1, "a", 2.0, 2), (2, "a", 1.0, 1), (2, "b", 2.0, 2)]
    assert _rows(table) == (after if (moment, when) == ("_commit", "after") else before)
    table.upsert(load)
    assert _rows(table) == after


KILLED_UPSERT = """
import os, sys
from pyspark.sql import SparkSession
from triprollup.sinks import keyed

path, shared = sys.argv[1:]
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", shared).getOrCreate()
)
whole = keyed.KeyedTable._write_copies

def die(*args):
    whole(*args)
    os._exit(9)

keyed.KeyedTable._write_copies = die
load = spark.createDataFrame([(1, "a", 2.0, 2)], "batch bigint, k string, v double, seq bigint")
keyed.open_keyed(spark, path).upsert(load)
"""


def test_a_killed_driver(spark, made, tmp_path):
    """The process dies between the copies and the commit."""
    table = made()
    table.upsert(_load(spark, (1, "a", 1.0, 1), (1, "b", 1.0, 1)))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", KILLED_UPSERT, table.path, str(tmp_path / "shared")],
        cwd=root, timeout=240, capture_output=True, check=False,
    )
    assert done.returncode == 9, done.stderr[-2000:]
    assert _rows(table) == [(1, "a", 1.0, 1), (1, "b", 1.0, 1)]
    assert len(os.listdir(f"{table.path}/rows")) == 2
    assert table.remove_stale(0) == 1
    table.upsert(_load(spark, (1, "a", 3.0, 3)))
    assert _rows(table) == [(1, "a", 3.0, 3), (1, "b", 1.0, 1)]


def test_two_writers_at_once(spark, made, monkeypatch):
    """The second merges again, upon what the first one made: nothing is lost."""
    table = made()
    table.upsert(_load(spark, (1, "a", 1.0, 1)))
    real, other = keyed.KeyedTable._commit, []

    def late(self, *args):
        if not other:
            other.append(1)
            table.upsert(_load(spark, (1, "b", 2.0, 2), (2, "b", 2.0, 2)))
        return real(self, *args)

    with monkeypatch.context() as patch:
        patch.setattr(keyed.KeyedTable, "_commit", late)
        table.upsert(_load(spark, (1, "c", 3.0, 3)))
    expected = [(1, "a", 1.0, 1), (1, "b", 2.0, 2), (1, "c", 3.0, 3), (2, "b", 2.0, 2)]
    assert _rows(table) == expected and table.version() == 3
    monkeypatch.setattr(keyed.KeyedTable, "_commit", lambda *_: False)
    with pytest.raises(OtherWriter):
        table.upsert(_load(spark, (1, "d", 3.0, 3)))
    monkeypatch.undo()
    assert _rows(table) == expected
    assert table.remove_stale(0) > 4 and _rows(table) == expected


def test_versions_over_several_epochs(spark, made, monkeypatch):
    monkeypatch.setattr(commits, "EPOCH", 3)
    table, held, rng = made(), {}, random.Random(2)
    for seq in range(8):
        load = [(rng.randrange(3), rng.choice("abc"), float(seq), seq) for _ in range(2)]
        load = list({r[:2]: r for r in load}.values())
        held.update((r[:2], r) for r in load)
        table.upsert(_load(spark, *load))
        assert _rows(table) == sorted(held.values(), key=repr)
    before = len(os.listdir(f"{table.path}/commits"))
    assert before == 3 and table.remove_stale(0) > 2
    assert len([n for n in os.listdir(f"{table.path}/commits") if n.startswith("epoch")]) == 1
    assert _rows(table) == sorted(held.values(), key=repr) and table.version() == 8


def test_young_copies_are_not_removed(spark, made):
    table = made()
    for seq in range(3):
        table.upsert(_load(spark, (1, "a", 1.0, seq)))
    opened = table.rows()
    table.upsert(_load(spark, (1, "a", 9.0, 9)))
    assert table.remove_stale() == 0 and opened.count() == 1
    assert table.remove_stale(0) == 3 and _rows(table) == [(1, "a", 9.0, 9)]
