import datetime as dt
import itertools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history as h
from tidemark.plans.snapshots import HistoryTable
from tidemark.queries import QUERIES

D1, D2, D3, D4 = (dt.date(2024, 1, d) for d in (1, 2, 3, 4))


def snap(spark, rows):
    return spark.createDataFrame(rows, "k int, a string, b double")


def day(d):
    return F.lit(d).cast("date")


OLD = [(1, "x", 1.0), (2, None, 2.0), (3, "z", None), (4, "w", 4.0)]
NEW = [(1, "x", 1.0), (2, None, 2.5), (3, None, None), (5, "v", 5.0)]


def test_diff_is_null_safe(spark):
    got = h.snapshot_diff(snap(spark, OLD), snap(spark, NEW), ["k"])
    assert {r["k"]: r["op"] for r in got.collect()} == {
        1: "same", 2: "update", 3: "update", 4: "delete", 5: "insert",
    }


SPELLINGS = [
    ("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("ab", None), (None, None), ("", ""), ("-", "-"),
    ("1:a", "b"), ("a1:b", ""), ("é", "b"),
]


def test_digest_tells_rows_apart(spark):
    rows = [(i, a, b) for i, (a, b) in enumerate(SPELLINGS)]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    assert df.select(h.row_digest(df, ["a", "b"])).distinct().count() == len(SPELLINGS)
    with pytest.raises(TypeError):
        h.row_digest(spark.sql("select array(1) as x"), ["x"])


def test_digest_agrees_with_values(spark):
    schema = "k int, d double, m decimal(12,2), t timestamp, n timestamp_ntz, b binary, f boolean"
    ts = dt.datetime(2024, 1, 1, 0, 0, 0, 1)
    old = [(i, 0.0, None, ts, ts, b"x", True) for i in range(8)]
    new = [list(r) for r in old]
    new[1][1] = -0.0
    new[2][1] = float("nan")
    new[3][2] = Decimal(0)
    new[4][3] = new[5][4] = ts + dt.timedelta(microseconds=1)
    new[6][5] = b"y"
    new[7][6] = None
    a = spark.createDataFrame(old, schema)
    b = spark.createDataFrame([tuple(r) for r in new], schema)
    ops = [
        {r["k"]: r["op"] for r in h.snapshot_diff(a, b, ["k"], by_digest=d).collect()} for d in (False, True)
    ]
    assert ops[0] == ops[1] == {0: "same", 1: "same"} | dict.fromkeys(range(2, 8), "update")


def test_digest_leaves_wide_columns_behind(spark, sf_dir, plan_of):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = plan_of(h.snapshot_diff(docs, docs, ["doc_id"], by_digest=True, check_keys=False))
    shuffled = [line for line in plan.split("Exchange\n")[1:]]
    assert shuffled and all("text#" not in part.split("\n")[0] for part in shuffled)


def test_all_null_row_is_not_taken_for_a_missing_one(spark):
    old = snap(spark, [(1, None, None)])
    got = h.snapshot_diff(old, old, ["k"])
    assert got.first()["op"] == "same"
    gone = h.snapshot_diff(old, old.where("k < 0"), ["k"])
    assert gone.first()["op"] == "delete"


def test_applied_diff_gives_the_new_snapshot(spark):
    old, new = snap(spark, OLD), snap(spark, NEW)
    got = h.apply_diff(old, h.snapshot_diff(old, new, ["k"]), new, ["k"])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, new.collect()))


@pytest.mark.parametrize("bad", [[(1, "x", 1.0), (1, "y", 1.0)], [(None, "x", 1.0)]])
def test_snapshot_without_a_key_is_refused(spark, bad):
    with pytest.raises(h.NotAKey):
        h.require_keys({"new": snap(spark, bad)}, ["k"])
    for old, new in ((OLD, bad), (bad, OLD)):
        with pytest.raises(Exception, match="NotAKey"):
            h.snapshot_diff(snap(spark, old), snap(spark, new), ["k"]).collect()
        with pytest.raises(Exception, match="NotAKey"):
            h.extend_history(h.open_history(snap(spark, old), day(D1)), snap(spark, new), ["k"], day(D2)).collect()


def test_rows_of_a_key_that_arrives_twice_are_each_compared(spark):
    old = snap(spark, [(1, "x", 1.0), (2, "y", 0.0), (3, None, 3.0), (4, "q", 4.0)])
    new = snap(spark, [(1, "x", 1.0), (1, "z", 1.0), (2, "y", -0.0), (2, "y", 0.0), (3, None, 9.0), (5, "n", 5.0), (5, "n", 5.0)])
    want = [(1, "same"), (1, "update"), (2, "same"), (2, "same"), (3, "update"), (4, "delete"), (5, "insert"), (5, "insert")]
    for by_digest in (False, True):
        diff = h.snapshot_diff(old, new, ["k"], by_digest=by_digest, new_repeats=True)
        assert sorted((r["k"], r["op"]) for r in diff.collect()) == want
    patched = h.apply_diff(old, diff, new, ["k"])
    assert sorted(map(str, patched.collect())) == sorted(map(str, new.collect()))
    with pytest.raises(Exception, match="NotAKey"):
        h.snapshot_diff(new, old, ["k"], new_repeats=True).collect()
    with pytest.raises(Exception, match="NotAKey"):
        h.snapshot_diff(old, snap(spark, [(None, "x", 1.0)]), ["k"], new_repeats=True).collect()


@pytest.mark.parametrize("name", ["snapshot_diff", "snapshot_diff_by_digest", "diff_of_versions", "snapshot_patch"])
def test_customers_with_keys_like_those_that_arrive(spark, tmp_path, name):
    rows = [(k, float(k)) for k in (*range(8), 57, 60, 100000, 100001, 100007)] + [(100002, 2.0)]
    spark.createDataFrame(rows, "c_custkey bigint, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    balance = dict(rows)
    new = [(k, v + 100 if k % 20 == 0 else v) for k, v in rows if k % 50 != 7] + [(k + 100000, float(k)) for k in range(5)]
    ops = [(k, "insert" if k not in balance else "same" if v == balance[k] else "update") for k, v in new]
    ops += [(k, "delete") for k in balance if k not in dict(new)]
    want = {"snapshot_patch": new, "diff_of_versions": [o for o in ops if o[1] != "same"]}.get(name, ops)
    assert sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).collect())) == sorted(want)


def test_diff_is_one_shuffle_and_no_other_job(spark, plan_of):
    plan = plan_of(h.snapshot_diff(snap(spark, OLD), snap(spark, NEW), ["k"]), "simple")
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_columns_that_come_and_go(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", None)], "k int, gone string, both int")
    new = spark.createDataFrame([(1, 1, 5), (2, None, None)], "k int, both int, come int")
    assert {r["k"]: r["op"] for r in h.snapshot_diff(old, new, ["k"]).collect()} == {1: "update", 2: "update"}
    assert {r["op"] for r in h.snapshot_diff(old.drop("gone"), new, ["k"]).where("k = 2").collect()} == {"same"}
    assert {r["op"] for r in h.snapshot_diff(old, new, ["k"], by_digest=True).collect()} == {"update"}
    with pytest.raises(TypeError):
        h.snapshot_diff(old, new.withColumn("gone", F.lit(1)), ["k"])
    history = h.extend_history(h.open_history(old, day(D1)), new, ["k"], day(D2))
    assert {(r["k"], r["gone"], r["come"], r["is_current"]) for r in history.collect() if r["k"] == 1} == {
        (1, "a", None, False), (1, None, 5, True),
    }
    patched = h.apply_diff(old, h.snapshot_diff(old, new, ["k"]), new, ["k"])
    assert {tuple(r) for r in patched.select("k", "both", "come").collect()} == {(1, 1, 5), (2, None, None)}


def test_history_does_not_go_back(spark):
    history = h.open_history(snap(spark, OLD), day(D2))
    for earlier in (D1, D2):
        with pytest.raises(h.NotLater):
            h.extend_history(history, snap(spark, NEW), ["k"], day(earlier))
    with pytest.raises(TypeError):
        h.extend_history(history, snap(spark, NEW), ["k"], F.lit("2024-01-09").cast("timestamp"))


def spans(history):
    return sorted(
        (r["k"], r["a"], r["valid_from"], r["valid_to"], r["is_current"]) for r in history.collect()
    )


def test_history_over_several_snapshots(spark):
    history = h.open_history(snap(spark, [(1, "p", 0.0), (2, "q", 0.0)]), day(D1))
    for rows, when in (
        ([(1, "p", 0.0), (2, "r", 0.0), (3, "s", 0.0)], D2),
        ([(1, "p", 0.0), (3, "s", 0.0)], D3),
        ([(1, "t", 0.0), (2, "r", 0.0), (3, "s", 0.0)], D4),
    ):
        history = h.extend_history(history, snap(spark, rows), ["k"], day(when))
    assert spans(history) == [
        (1, "p", D1, D4, False),
        (1, "t", D4, None, True),
        (2, "q", D1, D2, False),
        (2, "r", D2, D3, False),
        (2, "r", D4, None, True),
        (3, "s", D2, None, True),
    ]


def test_history_invariants(spark):
    history = h.open_history(snap(spark, OLD), day(D1))
    history = h.extend_history(history, snap(spark, NEW), ["k"], day(D2))
    current = history.where("is_current")
    assert current.groupBy("k").count().where("count > 1").isEmpty()
    assert {r["k"] for r in current.collect()} == {1, 2, 3, 5}
    a, b = history.alias("a"), history.alias("b")
    overlap = a.join(b, F.col("a.k") == F.col("b.k")).where(
        "a.valid_from < b.valid_from and coalesce(a.valid_to, date'9999-12-31') > b.valid_from"
    )
    assert overlap.isEmpty()


def test_unchanged_snapshot_changes_nothing(spark):
    history = h.open_history(snap(spark, OLD), day(D1))
    again = h.extend_history(history, snap(spark, OLD), ["k"], day(D2))
    assert spans(again.na.fill({"a": ""})) == spans(history.na.fill({"a": ""}))


def test_newest_version_wins_and_ties_are_broken(spark):
    base = spark.createDataFrame([(1, "a", 1, 1), (2, "b", 1, 1)], "k int, v string, m int, seq int")
    changes = spark.createDataFrame([(1, "c", 2, 1), (2, "d", 1, 2), (3, "e", 1, 1)], base.schema)
    got = h.upsert(base, changes, ["k"], "m", ["seq"])
    assert sorted((r["k"], r["v"]) for r in got.collect()) == [(1, "c"), (2, "d"), (3, "e")]


def test_versions_are_reduced_before_the_shuffle(spark, plan_of):
    df = spark.createDataFrame([(1, 1)], "k int, m int")
    plan = plan_of(h.newest_per_key(df, ["k"], "m"), "simple")
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_replacing_few_rows_does_not_shuffle_the_base(spark, sf_dir, plan_of):
    base = spark.read.parquet(f"{sf_dir}/customer.parquet")
    plan = plan_of(h.replace_by_key(base, base.where("c_custkey < 9"), ["c_custkey"]), "simple")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_replacing_many_rows_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr("tidemark.functions.sizes.MAX_BROADCAST_ROWS", 2)
    from tidemark.functions import sizes

    assert not sizes.fits(spark.range(10), max_rows=2)
    assert sizes.fits(spark.range(10), max_rows=10)
    wide = spark.range(10).selectExpr("repeat('x', 1000) as s")
    assert not sizes.fits(wide, max_rows=100, max_bytes=5000)


def test_sorted_snapshot(spark):
    got = h.sorted_snapshot(spark.range(100).orderBy(F.rand(1)), ["id"], 4)
    parts = got.withColumn("p", F.spark_partition_id()).collect()
    assert [r["id"] for r in parts] == list(range(100))
    assert len({r["p"] for r in parts}) > 1


@pytest.fixture
def warehouse(spark):
    """Tables entered in the catalog by a test are taken out again."""
    before = {t.name for t in spark.catalog.listTables()}
    yield
    for t in spark.catalog.listTables():
        if t.name not in before:
            spark.sql(f"DROP TABLE {t.name}")


def test_bucketed_history_shuffles_only_the_snapshot(spark, tmp_path, plan_of, warehouse):
    table = HistoryTable(spark, str(tmp_path / "h"), ["k"], buckets=3)
    table.load(snap(spark, OLD), day(D1))
    for d in (D2, D3):
        table.load(snap(spark, NEW), day(d))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        after = table.versions_after(table.table.live_version(), snap(spark, OLD), day(D4))
        plan = plan_of(after, "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    files = [f.split("/")[-1] for f in table.current().inputFiles()]
    assert 0 < len(files) <= 3
    unaware = HistoryTable(spark, str(tmp_path / "h"), ["k"])
    rows = sorted(map(repr, table.read().collect()))
    assert rows == sorted(map(repr, unaware.read().select(*table.read().columns).collect()))


@pytest.mark.parametrize("buckets", [0, 3])
def test_history_table_writes_closed_rows_once(spark, tmp_path, warehouse, buckets):
    table = HistoryTable(spark, str(tmp_path / "h"), ["k"], buckets)
    with pytest.raises(LookupError):
        table.read()
    expected = None
    for rows, when in ((OLD, D1), (NEW, D2), (NEW, D3), (OLD, D4)):
        table.load(snap(spark, rows), day(when))
        expected = (
            h.open_history(snap(spark, rows), day(when))
            if expected is None
            else h.extend_history(expected, snap(spark, rows), ["k"], day(when))
        )
        got = table.read()
        assert sorted(map(repr, got.select(*expected.columns).collect())) == sorted(
            map(repr, expected.collect())
        )
    assert table.current().count() == len(OLD)
    third = table.table.published_versions()[2]
    assert table.table.staged(third).where("not is_current").isEmpty()


@pytest.mark.parametrize("buckets", [0, 2])
def test_history_survives_a_snapshot_that_loses_everything(spark, tmp_path, warehouse, buckets):
    table = HistoryTable(spark, str(tmp_path / "h"), ["k"], buckets)
    for d in (dt.date(2023, 1, 1), dt.date(2023, 1, 2)):
        table.load(snap(spark, OLD).where("k < 0"), day(d))
        table = HistoryTable(spark, str(tmp_path / "h"), ["k"], buckets)
        assert table.read().count() == 0
    table.load(snap(spark, OLD), day(D1))
    table.load(snap(spark, OLD).where("k < 0"), day(D2))
    assert table.current().count() == 0 and table.read().count() == len(OLD)
    table.load(snap(spark, NEW), day(D3))
    assert table.current().count() == len(NEW) and table.read().count() == len(OLD) + len(NEW)


@pytest.mark.parametrize("buckets", [0, 2])
def test_closed_rows_outlive_the_versions_that_closed_them(spark, tmp_path, warehouse, buckets):
    table = HistoryTable(spark, str(tmp_path / "h"), ["k"], buckets)
    for rows, d in ((OLD, D1), (NEW, D2), (OLD, D3)):
        table.load(snap(spark, rows), day(d))
    whole = sorted(map(repr, table.read().collect()))
    for version in table.table.published_versions()[:-1]:
        _remove(spark, table.table.version_path(version))
    again = HistoryTable(spark, str(tmp_path / "h"), ["k"])
    assert sorted(map(repr, again.read().select(*table.read().columns).collect())) == whole
    with pytest.raises(h.NotLater):
        again.load(snap(spark, NEW), day(D3))
    with pytest.raises(TypeError):
        again.load(snap(spark, NEW), F.lit("2024-02-01").cast("timestamp"))
    _remove(spark, table.closed_path(table.table.published_versions()[1]))
    with pytest.raises(LookupError):
        again.read()


LATE = {
    D1: [(1, "x", 1.0), (2, None, 2.0), (3, "z", None), (4, "w", 4.0), (7, "t", 1.0), (8, None, None)],
    D2: [(1, "x", 1.0), (2, None, 2.5), (5, "v", 5.0), (6, "u", 1.0), (7, "s", 1.0), (8, None, None)],
    D3: [(1, "x", 1.0), (2, None, 2.5), (3, "z", None), (6, "u", 2.0), (7, "t", 1.0)],
}


def _plain_history(snapshots):
    """One version per run of equal rows of a key in consecutive snapshots."""
    days = sorted(snapshots)
    states = [{r[0]: r[1:] for r in snapshots[d]} for d in days]
    out = []
    for k in {k for state in states for k in state}:
        for i, state in enumerate(states):
            if k in state and not (i and states[i - 1].get(k) == state[k]):
                end = next((days[j] for j in range(i, len(days)) if states[j].get(k) != state[k]), None)
                out.append((k, *state[k], days[i], end, end is None))
    return sorted(map(repr, out))


def _rows(df):
    return sorted(map(repr, map(tuple, df.select("k", "a", "b", h.VALID_FROM, h.VALID_TO, h.IS_CURRENT).collect())))


def test_snapshots_are_spliced_in_any_order(spark):
    want = _plain_history(LATE)
    for order in itertools.permutations(LATE):
        loaded, history = [], None
        for d in order:
            new = snap(spark, LATE[d])
            later = [x for x in loaded if x > d]
            if history is None:
                history = h.open_history(new, day(d))
            elif later:
                history = h.splice_history(history, new, ["k"], day(d), day(min(later)))
            else:
                history = h.extend_history(history, new, ["k"], day(d))
            history = spark.createDataFrame(history.collect(), history.schema)
            loaded.append(d)
            assert _rows(history) == _plain_history({x: LATE[x] for x in loaded}), (order, d)
        assert _rows(history) == want


def test_a_late_snapshot_needs_keys_and_brings_columns(spark):
    history = h.extend_history(h.open_history(snap(spark, OLD), day(D1)), snap(spark, NEW), ["k"], day(D3))
    for bad in ([(1, "x", 1.0), (1, "y", 1.0)], [(None, "x", 1.0)]):
        with pytest.raises(Exception, match="NotAKey"):
            h.splice_history(history, snap(spark, bad), ["k"], day(D2), day(D3)).collect()
    wider = snap(spark, NEW).withColumn("come", F.lit(7))
    got = h.splice_history(history, wider, ["k"], day(D2), day(D3)).where("k = 1").orderBy(h.VALID_FROM).collect()
    assert [(r["come"], r[h.VALID_FROM], r[h.VALID_TO]) for r in got] == [(None, D1, D2), (7, D2, D3), (None, D3, None)]
    empty = h.splice_history(history, snap(spark, []), ["k"], day(D2), day(D3))
    assert empty.where((F.col(h.VALID_FROM) <= day(D2)) & (F.col(h.VALID_TO).isNull() | (F.col(h.VALID_TO) > day(D2)))).count() == 0


@pytest.mark.parametrize("buckets, order", [(0, (D1, D3, D2)), (2, (D3, D2, D1)), (0, (D3, D1, D2))])
def test_late_loads(spark, tmp_path, warehouse, buckets, order):
    table = HistoryTable(spark, str(tmp_path / "h"), ["k"], buckets)
    for d in order:
        table.load(snap(spark, LATE[d]), day(d))
        with pytest.raises(h.NotLater):
            table.load(snap(spark, LATE[d]), day(d))
    assert _rows(table.read()) == _plain_history(LATE)
    table.load(snap(spark, LATE[D1]), day(D4))
    assert _rows(table.read()) == _plain_history({**LATE, D4: LATE[D1]})


def test_a_late_load_leaves_earlier_closed_rows_alone(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "h"), ["k"])
    versions = [table.load(snap(spark, rows), day(d)) for rows, d in ((OLD, D1), (NEW, D2), (OLD, D4))]
    table.load(snap(spark, NEW), day(D3))
    read = {f.split("/closed/")[1].split("/")[0] for f in table.read().inputFiles() if "/closed/" in f}
    assert versions[1] in read and versions[2] not in read
    assert _rows(table.read()) == _plain_history({D1: OLD, D2: NEW, D3: NEW, D4: OLD})


def _remove(spark, path):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)
