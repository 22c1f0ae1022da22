"""Feeds: compressed files in folders, written without sorting whole lines."""

import os

from triprollup.plans.lineitem_trips import write_feed
from triprollup.sources.messages import line_messages


def _files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_a_feed_is_compressed_and_whole(spark, tmp_path):
    path, name = str(tmp_path / "feed"), "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    rows = spark.range(0, 300_000, 1, 2).selectExpr("concat('a line of some length, number ', id) as value", "if(id % 41 = 40, null, id % 41) as k")
    size = write_feed(rows, path, "k")
    plain = rows.selectExpr("sum(octet_length(value) + 1)").first()[0]
    assert size == sum(map(os.path.getsize, _files(path))) < plain / 2
    assert len({os.path.dirname(f) for f in _files(path)}) == 41
    found = line_messages(spark, path)
    assert found.count() == 300_000 and found.exceptAll(rows.select("value")).isEmpty()
    assert spark.conf.get(name) == before


def test_a_compressed_file_is_bounded(spark, tmp_path):
    path = str(tmp_path / "feed")
    write_feed(spark.range(0, 300_000, 1, 1).selectExpr("'x' as value"), path)
    assert len(_files(path)) == 3
