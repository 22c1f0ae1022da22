"""Differences of two tables against a plain multiset difference."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from triprollup.operators import drilldown

SCHEMA = "batch bigint, k string, v double, note string"


def _side(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def _found(left, right, keys=("k",)):
    rows = drilldown.drill_down(left, right, "batch", keys).collect()
    return Counter({(r["side"], *r[:4]): r["n_copies"] for r in rows})


def _by_hand(left, right):
    a, b = Counter(left), Counter(right)
    found = Counter({("left", *r): n for r, n in (a - b).items()})
    found.update({("right", *r): n for r, n in (b - a).items()})
    return found


ROWS = [(b, k, v, n) for b in (1, 2, None) for k in ("a", "b", None) for v in (1.0, 2.5, None) for n in ("x", None)]
ROWS += ROWS[:9]


@pytest.mark.parametrize("named", [2_000, 0])
def test_changed_added_missing_and_repeated_rows(spark, monkeypatch, named):
    monkeypatch.setattr(drilldown, "NAMED_BATCHES", named)
    changes = [
        [],
        [(2, "a", 1.0, "x", "minus")],
        [(2, "a", 1.0, "x", "minus"), (2, "a", 1.5, "x", "plus"), (None, None, None, None, "minus")],
        [(7, "new", 1.0, None, "plus"), (1, "a", None, "x", "plus"), (1, "a", 1.0, "x", "minus")],
    ]
    for change in changes:
        other = list(ROWS)
        for *row, what in change:
            (other.remove if what == "minus" else other.append)(tuple(row))
        for left, right in ((ROWS, other), (other, ROWS)):
            found = _found(_side(spark, left), _side(spark, right))
            assert found == _by_hand(left, right)


def test_null_is_no_value_and_columns_are_told_apart(spark):
    left = [(1, "a", None, "x"), (1, None, 1.0, "b")]
    right = [(1, "a", None, None), (1, "b", 1.0, None)]
    assert _found(_side(spark, left), _side(spark, right)) == _by_hand(left, right)
    assert _found(_side(spark, left), _side(spark, [])) == _by_hand(left, [])
    assert not _found(_side(spark, []), _side(spark, []))


def test_column_order_does_not_matter_but_columns_do(spark):
    left = _side(spark, ROWS)
    assert not _found(left, left.select("note", "v", "k", "batch"))
    with pytest.raises(ValueError):
        drilldown.drill_down(left, left.drop("v"), "batch", ["k"])


def test_only_differing_batches_are_read_again(spark, tmp_path):
    paths = [str(tmp_path / side) for side in ("left", "right")]
    rows = spark.range(1000).select((F.col("id") % 50).alias("batch"), (F.col("id") % 7).alias("k"), "id")
    rows.write.partitionBy("batch").parquet(paths[0])
    changed = F.when(F.col("id").isin(3, 17), -1).otherwise(F.col("id"))
    rows.withColumn("id", changed).write.partitionBy("batch").parquet(paths[1])
    sides = [spark.read.schema("k bigint, id bigint, batch bigint").parquet(p) for p in paths]
    found = drilldown.drill_down(*sides, "batch", ["k"])
    assert sorted((r["side"], r["batch"], r["id"]) for r in found.collect()) == [
        ("left", 3, 3), ("left", 17, 17), ("right", 3, -1), ("right", 17, -1),
    ]
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"PartitionFilters: \[[^\]]*IN \(([\d,]+)\)", plan)
    assert len(scans) >= 2 and {tuple(sorted(s.split(","))) for s in scans} == {("17", "3")}
