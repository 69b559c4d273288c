"""Digest trees of versions, leases on them and their removal."""

import re
from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import history
from tidemark.sinks import leases
from tidemark.sinks.digests import BUCKET, DigestedTable
from tidemark.sinks.published import PublishedTable
from tidemark.workspace import path_exists, run_dir

DDL = "k int, `v.w` string, z double"


def plain(old, new):
    ops = {k: "insert" for k in new.keys() - old.keys()} | {k: "delete" for k in old.keys() - new.keys()}
    return ops | {k: "update" for k in old.keys() & new.keys() if old[k] != new[k]}


def frame(spark, rows):
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], DDL)


def found(diff):
    got = [(r.k, r.op) for r in diff.collect()]
    assert len(got) == len(set(got))
    return dict(got)


ROWS = st.dictionaries(st.integers(0, 30), st.tuples(st.sampled_from(["", "a", None]), st.sampled_from([0.0, 1.5, None])), max_size=25)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, ROWS)
def test_diff_of_any_two(spark, old, new):
    table = DigestedTable(spark, run_dir(spark, "versions"), ["k"], buckets=7, fanout=3)
    before, after = (table.stage(frame(spark, rows))[0] for rows in (old, new))
    assert found(table.diff(before, after)) == plain(old, new)
    assert found(table.diff(before, before)) == {}


def test_only_buckets_that_differ_are_read(spark, tmp_path, plan_of):
    table = DigestedTable(spark, str(tmp_path / "t"), ["k"], buckets=64, fanout=8)
    rows = spark.range(2000).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("wide"))
    first = table.publish(rows)
    # the same rows in another order and column order have the same root
    again = table.publish(rows.orderBy(F.desc("k")).select("wide", "k", "v"))
    assert table.changed_buckets(first, again) == [] and table.diff(first, again).isEmpty()
    second = table.publish(rows.withColumn("v", F.when(F.col("k") == 77, "y").otherwise(F.col("v"))).where("k <> 1234"))
    buckets = table.changed_buckets(first, second)
    changed = table._whole(first).where("k in (77, 1234)").select(BUCKET).distinct()
    assert buckets == sorted(r[0] for r in changed.collect()) and len(buckets) <= 2
    diff = table.diff(first, second)
    plan = plan_of(diff, "simple")
    listed = re.findall(rf"PartitionFilters: \[.*?{BUCKET}#\d+ (?:IN \(([\d,]+)\)|= (\d+))", plan)
    assert [sorted(int(b) for b in (many or one).split(",")) for many, one in listed] == [buckets, buckets]
    assert "wide" not in plan and plan.count("Exchange") == 1
    assert found(diff) == {77: "update", 1234: "delete"}
    assert table.read().columns == ["k", "v", "wide"] and table.read().count() == 1999


def test_copies_and_null_keys(spark, tmp_path):
    table = DigestedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    one = table.stage(spark.createDataFrame([(1, "a", 0.0), (2, "b", 0.0)], DDL))[0]
    twice = table.stage(spark.createDataFrame([(1, "a", 0.0), (1, "a", 0.0), (2, "b", 0.0)], DDL))[0]
    null = table.stage(spark.createDataFrame([(1, "a", 0.0), (2, "b", 0.0), (None, "b", 0.0)], DDL))[0]
    for other in (twice, null):
        assert table.changed_buckets(one, other)
        with pytest.raises(Exception, match="NotAKey"):
            table.diff(one, other).collect()
    empty = table.stage(spark.createDataFrame([], DDL))[0]
    assert found(table.diff(empty, one)) == {1: "insert", 2: "insert"}


def test_versions_of_other_columns_are_compared_whole(spark, tmp_path):
    root = str(tmp_path / "t")
    table = DigestedTable(spark, root, ["k"], buckets=4)
    old = table.stage(spark.createDataFrame([(1, "a", 0.0), (2, "b", None)], DDL))[0]
    new = table.stage(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, `v.w` string"))[0]
    assert table.changed_buckets(old, new) is None
    assert found(table.diff(old, new)) == {1: "update", 3: "insert"}
    other = DigestedTable(spark, root, ["k"], buckets=5)
    same = other.stage(spark.createDataFrame([(1, "a", 0.0), (2, "c", None)], DDL))[0]
    assert found(other.diff(old, same)) == {2: "update"}


def test_refusals(spark, tmp_path):
    with pytest.raises(ValueError):
        DigestedTable(spark, str(tmp_path), ["k"], buckets=1 << 17)
    table = DigestedTable(spark, str(tmp_path / "t"), ["k"])
    with pytest.raises(ValueError):
        table.stage(spark.range(1).withColumnRenamed("id", "k"), ["k"])
    with pytest.raises(LookupError):
        table.changed_buckets("none", "none")


def test_cleaning_spares_what_is_needed(spark, tmp_path):
    table = DigestedTable(spark, str(tmp_path / "t"), ["id"], buckets=2)
    versions = [table.publish(spark.range(n)) for n in (1, 2, 3, 4, 5)]
    pending = table.stage(spark.range(6))[0]
    lease = leases.take_lease(table, versions[1])
    expired = leases.take_lease(table, versions[2], seconds=-1)
    reading = table.staged(versions[1])
    assert leases.clean(table) == [versions[0], versions[2]]
    assert reading.count() == 2 and table.read().count() == 5
    assert not path_exists(spark, f"{table.root}/digests/{versions[0]}") and not path_exists(spark, expired)
    assert found_ids(table.diff(versions[1], versions[4])) == {2, 3, 4}
    with pytest.raises(leases.VersionGone):
        leases.take_lease(table, versions[0])
    with pytest.raises(leases.VersionGone):
        table.flip(versions[0], replaces=versions[4])
    leases.give_back(table, lease)
    assert leases.clean(table, keep=0) == [versions[1], versions[3]]
    table.flip(pending)
    assert table.read().count() == 6
    assert leases.clean(table, keep=0, settle=timedelta(0)) == [versions[4]]


def found_ids(diff):
    return {r.id for r in diff.collect()}


def test_a_reader_that_comes_during_the_clean_up_keeps_its_version(spark, tmp_path, monkeypatch):
    table = PublishedTable(spark, str(tmp_path / "t"))
    old, _ = (table.publish(spark.range(n)) for n in (1, 2))
    before = leases.is_leased
    calls = []

    def late(table, version):
        calls.append(version)
        if len(calls) == 2:
            # entered between the first look at the leases and the mark
            monkeypatch.setattr(leases, "path_exists", lambda *_: False)
            leases.take_lease(table, version)
        return before(table, version)

    monkeypatch.setattr(leases, "is_leased", late)
    assert leases.clean(table, keep=0) == []
    assert table.staged(old).count() == 1 and not path_exists(spark, f"{table.root}/retired/{old}")


def test_history_survives_the_clean_up(spark, tmp_path):
    from tidemark.plans.snapshots import HistoryTable

    table = HistoryTable(spark, str(tmp_path / "h"), ["id"])
    for day, n in (("2024-01-01", 3), ("2024-01-02", 5), ("2024-01-03", 4)):
        table.load(spark.range(n), F.lit(day).cast("date"))
    before = sorted(map(str, table.read().collect()))
    assert len(leases.clean(table.table, keep=0)) == 2
    assert sorted(map(str, table.read().collect())) == before
    assert history.VALID_FROM in table.read().columns
