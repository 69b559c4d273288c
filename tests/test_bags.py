"""Differences of bags, and exact samples of groups."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import lookup, quality

ROW = st.tuples(st.integers(0, 2) | st.none(), st.sampled_from(["a", "b", None]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, max_size=25), st.lists(ROW, max_size=25))
def test_bags(spark, left, right):
    frames = [spark.createDataFrame(rows, "`a.b` int, side2 string") for rows in (left, right)]
    got = Counter(tuple(r) for r in quality.bag_difference(*frames).collect())
    a, b = Counter(left), Counter(right)
    assert got == Counter({("left", *r): n for r, n in (a - b).items()}) + Counter({("right", *r): n for r, n in (b - a).items()})
    counted = quality.bag_difference(*frames, counted=True).collect()
    assert Counter({tuple(r)[:-1]: r.n for r in counted}) == got


def test_many_copies_take_one_shuffle(spark, monkeypatch, plan_of):
    monkeypatch.setattr(quality, "COPIES", 7)
    left = spark.range(100).select((F.col("id") * 0).alias("x"))
    got = quality.bag_difference(left, left.limit(50).union(left.limit(1).select(F.lit(5).alias("x"))))
    assert Counter((r.side, r.x) for r in got.collect()) == {("left", 0): 50, ("right", 5): 1}
    plan = plan_of(quality.bag_difference(left, left.where("x = 1")), "simple")
    assert plan.count("Exchange") == 1 and "SortMergeJoin" not in plan


def plain(rows, n):
    out = []
    for g in {g for g, _, _ in rows}:
        held = sorted((d, k is not None, k or 0) for h, k, d in rows if h == g)[:n]
        out += [(g, k if known else None) for _, known, k in held]
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [0, 1, 7, 40, 10**6])
def test_samples(spark, n):
    rows = [("big", i, i * 7919 % 5000) for i in range(5000)]
    rows += [("small", i, i) for i in range(5)] + [(None, i, i % 3) for i in range(50)] + [("x", None, 1)]
    scaled = [(g, k, d << 45) for g, k, d in rows]
    df = spark.createDataFrame(scaled, "`g.g` string, k bigint, d bigint").repartition(5)
    got = lookup.sample_per_group(df, ["g.g"], ["k"], n, F.col("d"))
    assert got.columns == df.columns
    assert sorted(((r["g.g"], r["k"]) for r in got.collect()), key=str) == (plain(scaled, n) if n else [])


def test_a_bound_that_keeps_too_few_is_raised(spark):
    # all draws of a group are high, so the first bounds hold none of them
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), "id", ((F.col("id") + (1 << 20)) * (1 << 39)).alias("d"))
    got = lookup.sample_per_group(df, ["g"], ["id"], 3, F.col("d")).collect()
    assert sorted((r.g, r.id) for r in got) == [(0, 0), (0, 2), (0, 4), (1, 1), (1, 3), (1, 5)]


def test_default_draw_and_no_groups(spark):
    df = spark.range(1000)
    one = {r.id for r in lookup.sample_per_group(df, [], ["id"], 20).collect()}
    assert len(one) == 20
    assert one == {r.id for r in lookup.sample_per_group(df.repartition(3), [], ["id"], 20).collect()}
    assert one != {r.id for r in lookup.sample_per_group(df, [], ["id"], 20, seed=1).collect()}
    assert lookup.sample_per_group(df.where("id < 0"), [], ["id"], 20).collect() == []
    assert lookup.sample_per_group(df.where("id < 0"), ["id"], ["id"], 20).collect() == []
