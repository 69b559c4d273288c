import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import chunking as c
from tidemark.operators.lookup import fixed_size_sample


def pages_of(df, *columns):
    found = {}
    for r in df.collect():
        found.setdefault(r["_chunk_id"], []).append(tuple(r[x] for x in columns))
    return found


def assert_cuts(rows, keys, df, size):
    """Pages are disjoint, complete, of the right sizes and in key order."""
    got = pages_of(df, *df.drop("_chunk_id").columns)
    flat = [r for p in got.values() for r in p]
    assert sorted(map(repr, flat)) == sorted(map(repr, rows))
    n = len(rows)
    want = {i: min(size, n - i * size) for i in range(-(-n // size))}
    assert {i: len(p) for i, p in got.items()} == want
    places = [df.columns.index(k) for k in keys]

    def rank(row):
        return tuple((row[p] is not None, row[p] if row[p] is not None else 0) for p in places)

    for i in range(len(want) - 1):
        assert max(map(rank, got[i])) <= min(map(rank, got[i + 1]))


@pytest.mark.parametrize("n", [0, 1, 99, 100, 101, 1000])
@pytest.mark.parametrize("rows_per_bucket", [10_000, 70])
def test_unique_key(spark, n, rows_per_bucket):
    rows = [(i * 7919 % 100_003, f"v{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "k long, v string")
    assert_cuts(rows, ["k"], c.page_rows(df, ["k"], 100, rows_per_bucket), 100)


@pytest.mark.parametrize("rows_per_bucket", [10_000, 70])
def test_composite_text_key(spark, rows_per_bucket):
    rows = [(f"g{i % 7}", f"{i:05d}", i) for i in range(700)]
    df = spark.createDataFrame(rows, "a string, b string, v long")
    assert_cuts(rows, ["a", "b"], c.page_rows(df, ["a", "b"], 90, rows_per_bucket), 90)


@pytest.mark.parametrize("rows_per_bucket", [10_000, 50])
def test_composite_number_key(spark, rows_per_bucket):
    rows = [(i % 5, i, "x") for i in range(600)]
    df = spark.createDataFrame(rows, "a int, b long, v string")
    assert_cuts(rows, ["a", "b"], c.page_rows(df, ["a", "b"], 70, rows_per_bucket), 70)


@pytest.mark.parametrize("rows_per_bucket", [10_000, 50])
def test_hot_and_null_keys(spark, rows_per_bucket):
    """One key holds a third of the rows, another tenth has none, and rows repeat."""
    rnd = random.Random(1)
    rows = [(42, "same") for _ in range(400)] + [(None, "null") for _ in range(120)]
    rows += [(rnd.randrange(10_000), f"v{i}") for i in range(700)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, v string")
    assert_cuts(rows, ["k"], c.page_rows(df, ["k"], 64, rows_per_bucket), 64)


def test_numbers_too_large_for_doubles(spark):
    rows = [(2**62 + i, i) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, v long")
    assert_cuts(rows, ["k"], c.page_rows(df, ["k"], 41), 41)


def test_more_pages_than_can_be_looked_up(spark):
    rows = [(i % 97, i) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, v long")
    for rows_per_bucket in (10_000, 60):
        paged = c.page_rows(df, ["k", "v"], 50, rows_per_bucket, max_page_starts=2)
        assert_cuts(rows, ["k", "v"], paged, 50)


def test_rank_fallback_with_ties(spark):
    rows = [(7, "same")] * 200 + [(i, f"v{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "k int, v string")
    assert_cuts(rows, ["k"], c.page_rows(df, ["k"], 30, 40, max_page_starts=2), 30)


def test_column_names_that_need_quoting(spark):
    rows = [(i, i) for i in range(50)]
    df = spark.createDataFrame(rows, "`a.b` long, `c d` long")
    assert_cuts(rows, ["a.b"], c.page_rows(df, ["a.b"], 20), 20)


def test_tagging_moves_no_rows(spark, sf_dir, plan_of):
    lines = c.scan_position(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    for keys in (["l_orderkey", "l_linenumber"], ["l_shipdate"]):
        paged = c.page_table(lines, keys, 1000).tagged()
        before_subqueries = plan_of(paged).split("===== Subqueries")[0]
        assert "Exchange" not in before_subqueries
        assert "Join" not in before_subqueries


def test_chunk_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        c.page_rows(spark.range(3), ["id"], 0)
    with pytest.raises(ValueError):
        c.page_rows(spark.range(3), ["id"], -5)


@pytest.mark.parametrize("offset, fetch", [(0, 10), (95, 10), (40, 0), (200, 5), (0, 100)])
def test_deep_offset_equals_shallow(spark, offset, fetch):
    df = spark.createDataFrame([(i * 37 % 101, i) for i in range(100)], "k int, v int")
    shallow = c.offset_fetch(df, ["k"], offset, fetch)
    deep = c.offset_fetch(df, ["k"], offset, fetch, max_top_rows=-1)
    assert deep.collect() == shallow.collect()


def test_deep_offset_cuts_through_copies(spark):
    df = spark.createDataFrame([(1, "a")] * 50 + [(2, "b")] * 50, "k int, v string")
    got = c.offset_fetch(df, ["k"], 30, 40, max_top_rows=0).groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in got} == {1: 20, 2: 20}


def test_manifest_reports_short_pages(spark):
    stats = spark.createDataFrame([("t", 250, 3)], "table_name string, row_count long, num_chunks long")
    plan = c.chunk_plan(stats, 100)
    rows = [(i, i // 100) for i in range(250) if not 100 <= i < 110]
    found = c.manifest(spark.createDataFrame(rows, "v int, _chunk_id int"), 100)
    checked = c.check_manifest(plan, found.withColumn("table_name", F.lit("t")))
    got = {r["_chunk_id"]: (r["expected_rows"], r["n_rows"], r["error"]) for r in checked.collect()}
    assert got[0] == (100, 100, None)
    assert got[1] == (100, 90, "expected 100 rows, found 90")
    assert got[2] == (50, 50, None)


def test_union_needs_pages():
    with pytest.raises(ValueError):
        c.union_pages([])


def test_union_goes_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, a int")
    assert sorted(map(tuple, c.union_pages([a, b]).collect())) == [(1, "x"), (2, "y")]


def test_fixed_size_sample_is_exact_and_repeatable(spark):
    df = spark.range(1000)
    first = {r[0] for r in fixed_size_sample(df, "id", 50, seed=3).collect()}
    again = {r[0] for r in fixed_size_sample(df.repartition(7), "id", 50, seed=3).collect()}
    other = {r[0] for r in fixed_size_sample(df, "id", 50, seed=4).collect()}
    assert len(first) == 50 and first == again and first != other
    assert fixed_size_sample(df, "id", 5000).count() == 1000


@pytest.mark.parametrize("scanned", [True, False])
def test_both_plans_agree_on_ties(spark, tmp_path, scanned):
    """Few keys with many copies: the look-up and the numbering of whole rows, the top-N and the ranked keys."""
    df = spark.range(400).selectExpr("id", "cast(id % 3 as int) as k")
    df.repartition(5).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    rows = rows if scanned else rows.union(rows.where("id < 0"))
    looked_up = c.page_rows(rows, ["k"], 50)
    numbered = c.page_rows(rows, ["k"], 50, max_page_starts=0)
    per_page = lambda paged: sorted((r["_chunk_id"], r["k"], r["n"]) for r in paged.groupBy("_chunk_id", "k").agg(F.count("*").alias("n")).collect())
    assert per_page(looked_up) == per_page(numbered)
    if scanned:
        assert sorted(map(tuple, looked_up.collect())) == sorted(map(tuple, numbered.collect()))
    for offset, fetch in ((0, 10), (130, 9), (395, 10), (500, 3)):
        top = c.offset_fetch(rows, ["k"], offset, fetch).collect()
        deep = c.offset_fetch(rows, ["k"], offset, fetch, max_top_rows=0).collect()
        assert top == deep and len(top) == max(0, min(fetch, 400 - offset))


def test_long_keys_make_fewer_buckets(spark, monkeypatch):
    monkeypatch.setattr(c, "MAX_BOUND_BYTES", 2000)
    df = spark.range(5000).selectExpr("repeat('x', 100) || lpad(id, 6, '0') as k").repartition(3)
    paged = c.page_rows(df, ["k"], 1000, rows_per_bucket=100)
    got = {r["_chunk_id"]: (r["a"], r["n"]) for r in paged.groupBy("_chunk_id").agg(F.min("k").alias("a"), F.count("*").alias("n")).collect()}
    assert got == {i: ("x" * 100 + f"{1000 * i:06d}", 1000) for i in range(5)}
