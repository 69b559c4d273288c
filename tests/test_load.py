import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lookup, quality
from tidemark.plans import extract
from tidemark.plans.load import after_watermark, load_increment
from tidemark.sinks import tables
from tidemark.sinks.published import PublishedTable, PublishRefused
from tidemark.sources.documents import DocumentSource
from tidemark.sources.files import FileSource, list_files
from tidemark.streaming import increments
from tidemark.workspace import create_text, materialise, path_exists, session_dir, shared_dir

SCHEMA = "id int, ts timestamp_ntz"


def at(minute, day=1):
    return dt.datetime(2024, 1, day, 0, minute)


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def ids(spark, path):
    return sorted(r["id"] for r in spark.read.parquet(path).collect())


@pytest.mark.parametrize("day_column", [None, "event_date"])
def test_row_sharing_the_last_timestamp_is_not_lost(spark, tmp_path, day_column):
    path = str(tmp_path / "t")
    first = load_increment(rows(spark, (1, at(1)), (2, at(5))), path, "ts", ["id"], day_column=day_column)
    assert (first.added, first.high) == (2, at(5))
    grown = rows(spark, (1, at(1)), (2, at(5)), (3, at(5)), (4, at(9)))
    assert load_increment(grown, path, "ts", ["id"], day_column=day_column).added == 2
    assert load_increment(grown, path, "ts", ["id"], day_column=day_column).added == 0
    assert ids(spark, path) == [1, 2, 3, 4]


def test_late_row_within_the_lookback(spark, tmp_path):
    path = str(tmp_path / "t")
    load_increment(rows(spark, (1, at(1)), (2, at(30))), path, "ts", ["id"])
    late = rows(spark, (1, at(1)), (2, at(30)), (3, at(25)), (4, at(40)))
    got = load_increment(late, path, "ts", ["id"], lookback=dt.timedelta(minutes=10))
    assert (got.added, got.high) == (2, at(40))
    assert ids(spark, path) == [1, 2, 3, 4]


def test_day_follows_the_timestamp_not_the_load(spark, tmp_path):
    path = str(tmp_path / "t")
    load_increment(rows(spark, (1, at(1, 1)), (2, at(0, 2))), path, "ts", ["id"], day_column="d")
    load_increment(rows(spark, (3, at(1, 2))), path, "ts", ["id"], day_column="d")
    days = {r["id"]: r["d"].day for r in spark.read.parquet(path).collect()}
    assert days == {1: 1, 2: 2, 3: 2}


def test_lost_watermark_is_harmless(spark, tmp_path):
    """A load that stopped between its rows and its watermark is not doubled."""
    path = str(tmp_path / "t")
    load_increment(rows(spark, (1, at(1))), path, "ts", ["id"])
    rows(spark, (2, at(2))).write.mode("append").parquet(path)
    load_increment(rows(spark, (1, at(1)), (2, at(2)), (3, at(3))), path, "ts", ["id"])
    assert ids(spark, path) == [1, 2, 3]


def test_any_split_of_the_increments_gives_the_whole(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts")
    for i, cuts in enumerate(([100], [1, 500, 900], [])):
        path = str(tmp_path / f"t{i}")
        for cut in [*cuts, 10**9]:
            load_increment(events.where(F.col("event_id") < cut), path, "ts", ["event_id"])
        got = spark.read.parquet(path)
        assert got.count() == events.count() and got.exceptAll(events).isEmpty()


@pytest.mark.parametrize(
    "kind, zone, day_column",
    [("timestamp", "America/Los_Angeles", "d"), ("timestamp_ntz", "Asia/Tokyo", None)],
)
def test_watermark_in_any_session_zone(spark, tmp_path, kind, zone, day_column):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = [f"2024-11-03 {h:02}:{m:02}:00.000001" for h in range(0, 24, 3) for m in (0, 30)]
        texts += ["2024-11-03 08:30:00.5", "2024-11-03 09:30:00.5"]
        df = spark.createDataFrame(list(enumerate(texts)), "id int, s string")
        df = df.select("id", F.concat("s", F.lit("Z" if kind == "timestamp" else "")).cast(kind).alias("ts"))
        for cut in (5, 11, 18, 18):
            load_increment(df.where(F.col("id") < cut), path, "ts", ["id"], day_column=day_column)
        late = dt.timedelta(days=2)
        assert load_increment(df, path, "ts", ["id"], lookback=late, day_column=day_column).added <= 2
        assert ids(spark, path) == list(range(18))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_empty_increment(spark, tmp_path):
    path = str(tmp_path / "t")
    assert load_increment(spark.createDataFrame([], SCHEMA), path, "ts", ["id"]).added == 0
    load_increment(rows(spark, (1, at(1))), path, "ts", ["id"])
    assert load_increment(spark.createDataFrame([], SCHEMA), path, "ts", ["id"]).high == at(1)


def test_watermark_reaches_the_scan(spark, sf_dir, plan_of):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = plan_of(after_watermark(events, "ts", F.lit(at(0, 20))))
    assert "GreaterThan(ts,2024-01-20T00:00" in plan


def test_stream_continues_where_it_stopped(spark, tmp_path):
    source, path, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    frame = rows(spark, (1, at(1)))
    frame.write.parquet(f"{source}/part-1")
    for expected, new in (([1], 2), ([1, 2], 3), ([1, 2, 3], None)):
        stream = increments.file_stream(spark, f"{source}/*", frame.schema, files_per_batch=1)
        increments.append_available(stream, path, mark, day_of="ts")
        assert ids(spark, path) == expected
        if new:
            rows(spark, (new, at(new))).write.parquet(f"{source}/part-{new}")
    stream = increments.file_stream(spark, f"{source}/*", frame.schema)
    assert increments.rows_appended(increments.append_available(stream, path, mark, day_of="ts")) == 0


def test_publishing(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "t"))
    with pytest.raises(LookupError):
        table.read()
    table.publish(spark.range(10))
    first = table.read()
    table.publish(spark.range(20))
    assert table.read().count() == 20 and first.count() == 10
    with pytest.raises(PublishRefused):
        table.publish(spark.range(5), expected_rows=6)
    assert table.read().count() == 20
    version, written = table.stage(spark.range(3))
    assert written == 3 and table.read().count() == 20
    table.flip(version)
    assert table.read().count() == 3
    assert table.log().count() == 3


def test_failed_publish_is_never_seen(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "t"))
    table.publish(spark.range(4))
    with pytest.raises(Exception):
        table.publish(spark.range(4).select(F.raise_error(F.lit("boom")).cast("int").alias("id")))
    assert table.read().count() == 4


def test_insert_takes_the_named_columns_and_raises(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a", 2.0)], "x int, y string, z double")
    tables.insert_columns(df, path, ["z", "x"])
    assert spark.read.parquet(path).columns == ["z", "x"]
    with pytest.raises(Exception):
        tables.insert_columns(df, path, ["nope"])


def test_documents(spark, tmp_path):
    store = DocumentSource(spark, str(tmp_path))
    schema = "user_id int, meta struct<browser:string,os:string>, at timestamp"
    docs = spark.createDataFrame(
        [(1, ("Firefox", "iOS"), at(1)), (None, ("Chrome", "MacOS"), at(2))], schema
    )
    store.overwrite(docs, "web_events")
    store.append(docs.where("user_id is null"), "web_events")
    assert store.row_count("web_events") == 3
    inferred = store.read("web_events")
    assert inferred.where("user_id is null").select("meta.os").distinct().first()[0] == "MacOS"
    typed = store.read_as("web_events", schema)
    assert typed.schema.simpleString() == docs.schema.simpleString()
    assert typed.exceptAll(docs.unionByName(docs.where("user_id is null"))).isEmpty()
    store.overwrite(docs.limit(1), "web_events")
    assert store.row_count("web_events") == 1
    assert store.read_as("web_events", schema, pipeline="[]").count() == 1


def test_connector_options(spark):
    store = DocumentSource(spark, format="some.connector", database="db", options={"uri": "u"})
    assert store.connector_options("c", "[{}]") == {
        "uri": "u", "database": "db", "collection": "c", "pipeline": "[{}]",
    }


def test_file_listing_by_prefix(spark, sf_dir, plan_of):
    found = list_files(spark, sf_dir, "part")
    assert [r["path"].split("/")[-1] for r in found.collect()] == ["part.parquet"]
    assert "content" not in plan_of(found, "simple").split("ReadSchema")[1]


def test_active_jobs(spark):
    jobs = spark.createDataFrame(
        [(1, True, "load", 3), (2, True, None, 1), (3, False, "load", 2), (4, True, "load", 1)],
        "id int, IsActive boolean, JobName string, OrderBy int",
    )

    def run(name):
        found = lookup.active_jobs(jobs, F.col("IsActive"), F.col("JobName"), name, "OrderBy")
        return [r["id"] for r in found.collect()]

    assert run("load") == [4, 1] and run(None) == [2]


def test_latest_record_breaks_ties(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 9), (4, None)], "id int, at int")
    assert lookup.latest_record(df, "at", "id").first()["id"] == 3


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    folder = shared_dir(spark)
    if configured:
        assert folder == configured.rstrip("/")
    written = materialise(spark.range(3), "test")
    assert written.inputFiles()[0].removeprefix("file://").startswith(folder.removeprefix("file:").replace("//", ""))


@pytest.mark.parametrize("fmt, options", [("json", {}), ("csv", {"header": "true"})])
def test_paging_other_formats(spark, tmp_path, fmt, options):
    """Rows without positions of their own: unique keys, then keys that repeat."""
    df = spark.range(90).selectExpr("id", "id % 4 as k")
    df.write.format(fmt).options(**options).save(str(tmp_path / "t"))
    source = FileSource(spark, str(tmp_path), format=fmt, layout="{table}", options=options)
    for keys in (["id"], ["k"]):
        paged = source.read_paged("t", None, keys, 40)
        assert paged.columns == [*df.columns, "_chunk_id"]
        assert sorted(r["count"] for r in paged.groupBy("_chunk_id").count().collect()) == [10, 40, 40]
    store = DocumentSource(spark, str(tmp_path))
    if fmt == "json":
        assert store.read_paged("t", None, ["id"], 50).where("_chunk_id = 1").count() == 40


def test_nulls_are_landed_once(spark, tmp_path):
    """Rows without a key or a stamp, through repeated loads; what differs is kept, what is the same is not doubled."""
    path = str(tmp_path / "t")
    schema = "k int, v string, ts timestamp_ntz"
    one = dt.datetime(2024, 1, 1)
    first = [(1, "a", one), (None, "b", one), (2, "c", None), (None, "d", None)]
    more = [*first, (None, "e", one), (None, "f", None), (3, "g", None)]
    got = []
    for rows_ in (first, first, more, more):
        got.append(load_increment(spark.createDataFrame(rows_, schema), path, "ts", ["k"]))
    assert [(g.added, g.unstamped) for g in got] == [(4, 2), (0, 0), (3, 2), (0, 0)]
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == list("abcdefg")


@pytest.mark.parametrize(
    "kind, marks, lookback",
    [("date", [dt.date(2024, 1, d) for d in (1, 2, 3, 11)], dt.timedelta(days=1)), ("bigint", [8, 9, 10, 110], 1)],
)
def test_watermarks_of_other_types(spark, tmp_path, kind, marks, lookback):
    path = str(tmp_path / "t")
    for n in (2, 3, 4, 4):
        rows_ = [(i, m) for i, m in enumerate(marks[:n])]
        found = load_increment(spark.createDataFrame(rows_, f"k int, m {kind}"), path, "m", ["k"], lookback)
        assert found.high == marks[n - 1]
    late = spark.createDataFrame([(9, marks[3]), (8, marks[0])], f"k int, m {kind}")
    assert load_increment(late, path, "m", ["k"], lookback).added == 1  # the other is before the lookback
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(TypeError):
        load_increment(late.selectExpr("k", "cast(m as string) as m"), path + "x", "m", ["k"])


def test_the_last_flip_counts_and_a_stale_one_is_refused(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "t"))
    a, _ = table.stage(spark.range(1))
    b, _ = table.stage(spark.range(2))
    table.flip(b)
    with pytest.raises(PublishRefused):
        table.flip(a)  # staged when nothing was live
    table.flip(a, replaces=b)
    assert table.read().count() == 1 and table.published_versions() == [b, a]
    again = PublishedTable(spark, str(tmp_path / "t"))
    with pytest.raises(PublishRefused):
        again.flip(b, replaces=b)
    again.flip(b, replaces=a)
    assert table.read().count() == 2
    c, _ = table.stage(spark.range(3))
    number = table._last_number() + 1
    assert create_text(spark, f"{table._log_path}/{number:012d}.json", "")  # another flip that broke off
    table.flip(c)
    assert table.read().count() == 3
    assert not create_text(spark, f"{table._log_path}/{number:012d}.json", "x")


def test_listing(spark, tmp_path):
    for name in ("a.txt", "a[1].txt", "[x].txt", "b.txt", "_hidden", ".dot"):
        (tmp_path / name).write_text("x")
    names = lambda prefix: sorted(r["path"].split("/")[-1] for r in list_files(spark, str(tmp_path), prefix).collect())
    assert names("a") == ["a.txt", "a[1].txt"] and names("[") == ["[x].txt"] and names("a[") == ["a[1].txt"]
    assert names("") == ["[x].txt", "a.txt", "a[1].txt", "b.txt"]
    assert names("zz") == [] and list_files(spark, str(tmp_path / "none")).collect() == []
    expected = spark.createDataFrame([(1, "a"), (2, "b")], "ord int, pattern string")
    empty = quality.reconcile_names(list_files(spark, str(tmp_path), "zz"), "path", expected)
    assert quality.name_status(empty, expected).first()["missing_files"] == 2


def test_documents_of_several_lines_are_counted_as_such(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.json").write_text('[{"a": 1,\n "b": 2},\n {"a": 3},\n {"a": 4}]')
    store = DocumentSource(spark, str(tmp_path), options={"multiLine": "true"})
    assert store.row_count("c") == 3
    assert extract.extract_table(store, "c", database="elsewhere").audit["database"] is None


def test_intermediate_tables_belong_to_the_session(spark):
    written = materialise(spark.range(3), "test")
    assert written.count() == 3 and path_exists(spark, session_dir(spark))
    assert session_dir(spark) in "file://" + written.inputFiles()[0].removeprefix("file://")
