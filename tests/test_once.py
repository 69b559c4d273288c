"""Streams and loads that repeat nothing and count what comes late."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.history import replace_by_key
from tidemark.plans.load import load_increment
from tidemark.streaming import increments

SCHEMA = "id bigint, ts timestamp_ntz, v string"


def at(day, hour=0):
    return datetime(2024, 1, 1) + timedelta(days=day, hours=hour)


class Drops:
    def __init__(self, spark, root, column="ts", schema=SCHEMA, lookback=timedelta(0)):
        self.spark, self.column, self.schema, self.lookback = spark, column, schema, lookback
        self.source, self.path, self.mark = (f"{root}/{n}" for n in ("in", "out", "mark"))
        self.n = 0

    def arrive(self, *rows):
        self.spark.createDataFrame(list(rows), self.schema).coalesce(1).write.parquet(f"{self.source}/d{self.n}")
        self.n += 1

    def run(self, per_batch=None):
        kind = self.spark.createDataFrame([], self.schema).schema
        stream = increments.file_stream(self.spark, f"{self.source}/*", kind, files_per_batch=per_batch)
        increments.append_once(stream, self.path, self.mark, ["id"], self.column, self.lookback)

    def rows(self, *columns):
        found = increments.landed_rows(self.spark, self.path).select(*(columns or ("id", "v", "is_late"))).collect()
        return sorted((tuple(r) for r in found), key=str)

    def loads(self):
        return [tuple(r)[:5] for r in increments.loads_of(self.spark, self.path).orderBy("load").collect()]


def test_overlapping_drops(spark, tmp_path):
    drops = Drops(spark, tmp_path)
    drops.arrive((1, at(0), "a"), (2, at(1), "b"), (2, at(1), "b"))
    drops.run()
    drops.arrive((2, at(1), "b"), (3, at(2), "c"), (4, at(0, 5), "late"))
    drops.run()
    drops.run()
    assert drops.rows() == [(1, "a", False), (2, "b", False), (3, "c", False), (4, "late", True)]
    assert drops.loads() == [(0, 3, 2, 1, 0), (1, 3, 2, 1, 1)]


def test_nulls_and_ties(spark, tmp_path):
    drops = Drops(spark, tmp_path)
    first = [(None, at(0), "x"), (None, at(0), "x"), (None, at(0), "y"), (5, None, "no stamp"), (6, at(3), "b"), (6, at(2), "early")]
    drops.arrive(*first)
    drops.run()
    drops.arrive(*first, (7, None, "new"))
    drops.run()
    assert drops.rows("id", "v") == sorted([(None, "x"), (None, "y"), (5, "no stamp"), (6, "early"), (6, "b"), (7, "new")], key=str)
    assert [r[2] for r in drops.loads()] == [5, 1]  # the copy of another day is an event of its own


def test_lookback(spark, tmp_path):
    drops = Drops(spark, tmp_path, lookback=timedelta(days=2))
    drops.arrive((1, at(10), "a"))
    drops.run()
    drops.arrive((2, at(8), "in time"), (3, at(7, 23), "late"))
    drops.run()
    assert drops.rows() == [(1, "a", False), (2, "in time", False), (3, "late", True)]


@pytest.mark.parametrize("kind", ["timestamp", "date"])
def test_other_stamps(spark, tmp_path, kind):
    drops = Drops(spark, tmp_path, schema=f"id bigint, ts {kind}, v string")
    drops.arrive((1, at(1), "a"), (2, at(2), "b"))
    drops.run()
    drops.arrive((2, at(2), "b"), (3, at(0), "late"), (4, at(2), "same stamp"))
    drops.run()
    assert drops.rows() == [(1, "a", False), (2, "b", False), (3, "late", True), (4, "same stamp", False)]


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    drops = Drops(spark, tmp_path)
    for i in range(3):
        drops.arrive((i, at(i), "x"), (i + 1, at(i + 1), "x"))
        drops.run()
    before, loads = drops.rows(), drops.loads()
    assert len(before) == 4
    for name in os.listdir(f"{drops.mark}/commits"):
        if name.strip(".").startswith("2"):
            os.remove(f"{drops.mark}/commits/{name}")
    drops.run()
    assert (drops.rows(), drops.loads()) == (before, loads)


def test_any_dealing_of_events_lands_each_once(spark, tmp_path):
    rnd = random.Random(3)
    events = [(i, at(rnd.randrange(5), rnd.randrange(24)), f"v{i}") for i in range(60)]
    drops = Drops(spark, tmp_path)
    for _ in range(4):
        drops.arrive(*rnd.choices(events, k=40))
        drops.run(per_batch=1)
    drops.arrive(*events)
    drops.run()
    assert drops.rows("id", "v") == sorted(((i, v) for i, _, v in events), key=str)
    loads = drops.loads()
    assert sum(r[2] for r in loads) == 60 and all(r[1] == r[2] + r[3] for r in loads)


def test_only_the_days_of_a_batch_are_read(spark, tmp_path, plan_of, monkeypatch):
    drops = Drops(spark, tmp_path)
    drops.arrive(*[(i, at(i), "x") for i in range(5)])
    drops.run()
    plans, given = [], increments.not_landed
    monkeypatch.setattr(increments, "not_landed", lambda rows, landed, keys: plans.append(plan_of(landed)) or given(rows, landed, keys))
    drops.arrive((3, at(3), "x"))
    drops.run()
    (plan,) = plans
    assert "PartitionFilters" in plan and "event_date" in plan.split("PartitionFilters")[1].split("\n")[0]


def rows(spark, *given):
    return spark.createDataFrame(list(given), SCHEMA)


@pytest.mark.parametrize("day_column", [None, "day"])
def test_late_rows_are_set_apart_once(spark, tmp_path, day_column):
    path, late = str(tmp_path / "t"), str(tmp_path / "late")
    given = dict(column="ts", keys=["id"], lookback=timedelta(days=1), day_column=day_column, late_path=late)
    assert load_increment(rows(spark, (1, at(0), "a"), (2, at(9), "b")), path, **given).late == 0
    again = rows(spark, (1, at(0), "a"), (2, at(9), "b"), (3, at(5), "late"), (4, at(8, 1), "in time"), (None, at(2), "n"))
    for expected in (2, 0):
        got = load_increment(again, path, **given)
        assert got.late == expected
    assert sorted(r.id or 0 for r in spark.read.parquet(late).collect()) == [0, 3]
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 4]
    assert load_increment(again, path, "ts", ["id"], day_column=day_column).late is None


def test_replacing_null_keys(spark):
    base = spark.createDataFrame([(None, "a", 1), (1, "b", 2), (1, None, 3), (2, "c", 4)], "k int, `j.x` string, v int")
    changes = spark.createDataFrame([(None, "a", 10), (1, None, 30), (3, "z", 50)], "k int, `j.x` string, v int")
    got = replace_by_key(base, changes, ["k", "j.x"]).collect()
    assert sorted(r.v for r in got) == [2, 4, 10, 30, 50]
    one = replace_by_key(base, base.where(F.col("v") == 1).withColumn("v", F.lit(9)), ["k"])
    assert sorted(r.v for r in one.collect()) == [2, 3, 4, 9]
