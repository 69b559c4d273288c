"""Positions among bounds, for every type of key, against a plain search."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import ordering as o

RND = random.Random(11)
START = dt.datetime(1969, 12, 31, 23, 59, 58, 999_999)
STAMPS = [START + dt.timedelta(microseconds=RND.randrange(10**13)) for _ in range(60)]
STAMPS += [s.replace(microsecond=0) for s in STAMPS[:10]]
VALUES = {
    "int": [RND.randrange(-50, 50) for _ in range(80)],
    "bigint": [RND.choice([1, -1]) * RND.randrange(2**62, 2**63 - 1) for _ in range(60)] + [-(2**63), 2**63 - 1],
    "date": [dt.date(1960, 1, 1) + dt.timedelta(days=RND.randrange(20_000)) for _ in range(60)],
    "timestamp": STAMPS,
    "timestamp_ntz": STAMPS,
    "double": [RND.uniform(-1, 1) for _ in range(40)] + [float("inf"), float("-inf")],
    "decimal(10,2)": [Decimal(RND.randrange(-999, 999)) / 100 for _ in range(60)],
    "string": ["", "a", "a\0", "é", "\U0001f600", "￮"]
    + ["Customer#%09d" % RND.randrange(50) for _ in range(30)]
    + ["".join(RND.choice("ab") for _ in range(RND.randrange(12))) for _ in range(60)],
}


def sort_key(v):
    if v is None:
        return (0, b"")
    return (1, v.encode() if isinstance(v, str) else v)


@pytest.mark.parametrize("kind", sorted(VALUES))
def test_one_column(spark, kind):
    values = [*VALUES[kind], None]
    bounds = RND.sample(sorted(set(VALUES[kind]), key=sort_key), 20) + [None]
    df = spark.createDataFrame([(v,) for v in values], f"k {kind}")
    frame = spark.createDataFrame([(b,) for b in bounds], f"k {kind}")
    got = o.with_position(df, ["k"], frame, len(bounds), "p")
    assert got.columns == ["k", "p"]
    for r in got.collect():
        assert r["p"] == sum(sort_key(b) <= sort_key(r["k"]) for b in bounds), r


@pytest.mark.parametrize("kind", ["int", "string", "timestamp_ntz", "double"])
def test_two_columns(spark, kind):
    firsts = [*VALUES[kind][:6], None]
    rows = [(RND.choice(firsts), RND.choice([*range(5), None])) for _ in range(150)]
    bounds = RND.sample(sorted(set(rows), key=lambda r: tuple(map(sort_key, r))), 15)
    schema = f"a {kind}, b int"
    got = o.with_position(
        spark.createDataFrame(rows, schema), ["a", "b"], spark.createDataFrame(bounds, schema), 15, "p"
    )

    def order(pair):
        return tuple(map(sort_key, pair))

    for r in got.collect():
        assert r["p"] == sum(order(b) <= order((r["a"], r["b"])) for b in bounds), r


def test_no_bounds(spark):
    got = o.with_position(spark.range(3), ["id"], None, 0, "p")
    assert {r["p"] for r in got.collect()} == {0}


def test_stands_in_any_time_zone(spark):
    """A clock that is set back must not disturb the order of zoneless timestamps."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        times = [dt.datetime(2024, 10, 27, 1, 30) + dt.timedelta(minutes=10 * i) for i in range(20)]
        times += [dt.datetime(2024, 3, 31, 1, 30) + dt.timedelta(minutes=10 * i) for i in range(20)]
        df = spark.createDataFrame([(t,) for t in times], "k timestamp_ntz")
        got = o.with_position(df, ["k"], df, len(times), "p").withColumn("k", F.col("k").cast("string"))
        for r in got.collect():
            assert r["p"] == sum(str(t)[:16] <= r["k"][:16] for t in times)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_key_is_computed_once_for_all_steps(spark):
    bounds = spark.range(9).select(F.xxhash64("id").alias("k"), F.nullif("id", F.lit(3)).alias("l"))
    df = spark.range(50).select(F.xxhash64("id").alias("k"), F.col("id").alias("l"))
    placed = o.with_position(df, ["k", "l"], bounds, 9, "at")
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<= lambda ") == plan.count("<= ") > 0
    below = [tuple(b) for b in bounds.collect()]
    assert [r["at"] for r in placed.collect()] == [sum((b[0], -1 if b[1] is None else b[1]) <= (r["k"], r["l"]) for b in below) for r in df.collect()]
