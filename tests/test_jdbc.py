"""The JDBC path without a database: options, SQL text and the cutting of ranges."""

import random

import duckdb
import pytest

from tidemark.sources import predicates as p
from tidemark.sources.files import FileSource
from tidemark.sources.jdbc import JdbcSource
from tidemark.sources.registry import open_source

CONFIG = {
    "production": {
        "warehouse": {
            "kind": "SqlServer",
            "url": "jdbc:sqlserver://host:1433;databaseName=",
            "database": "model",
            "username": "reader",
            "password": {"env": "TIDEMARK_TEST_PASSWORD"},
            "driver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
        },
        "dw": {
            "kind": "postgres",
            "url": "jdbc:postgresql://host:5432/dw",
            "database": "ignored",
            "driver": "org.postgresql.Driver",
            "connections": 8,
        },
        "lake": {"kind": "files", "root": "/data"},
        "postgres_by_name_only": {"url": "jdbc:x"},
        "plain_secret": {"kind": "postgres", "url": "u", "driver": "d", "password": "oops"},
    }
}


def opened(spark, name):
    return open_source(spark, CONFIG, "production", name)


def test_sources_open_by_kind(spark, monkeypatch):
    monkeypatch.setenv("TIDEMARK_TEST_PASSWORD", "s3cret")
    ms = opened(spark, "warehouse")
    assert isinstance(ms, JdbcSource) and ms.kind == "sqlserver"
    assert ms.options()["url"].endswith("databaseName=model")
    assert ms.with_database("other").options()["url"].endswith("databaseName=other")
    assert ms.options()["password"] == "s3cret" and "s3cret" not in repr(ms)
    pg = opened(spark, "dw")
    assert pg.options()["url"] == "jdbc:postgresql://host:5432/dw" and "user" not in pg.options()
    assert isinstance(opened(spark, "lake"), FileSource)


def test_kind_is_never_guessed_and_secrets_never_written_out(spark):
    with pytest.raises(ValueError, match="unknown kind"):
        opened(spark, "postgres_by_name_only")
    with pytest.raises(ValueError, match="secret"):
        opened(spark, "plain_secret")


def test_overwriting_keeps_the_table(spark):
    opts = opened(spark, "dw").write_options("t", "raw")
    assert opts["truncate"] == "true" and opts["dbtable"] == '"raw"."t"'
    assert opts["numPartitions"] == "200"


def test_strides(spark):
    opts = opened(spark, "dw").stride_options("t", None, "id", 1, 900)
    got = {k: opts[k] for k in ("dbtable", "partitionColumn", "lowerBound", "upperBound", "numPartitions")}
    assert got == {
        "dbtable": '"raw"."t"', "partitionColumn": "id", "lowerBound": "1", "upperBound": "900", "numPartitions": "8",
    }


def test_count_and_key_queries():
    con = duckdb.connect()
    con.execute("CREATE SCHEMA raw")
    con.execute("CREATE TABLE raw.t (a INT, b INT, c INT, PRIMARY KEY (b, a))")
    con.execute("INSERT INTO raw.t VALUES (1, 1, 1), (2, 1, 1)")
    assert con.execute(p.count_query("t", None)).fetchall() == [(2,)]
    assert con.execute(p.ends_query("t", None, "a")).fetchall() == [(1, 2)]
    found = con.execute(p.key_query("t", "raw")).fetchall()
    assert [name for name, _ in sorted(found, key=lambda r: r[1])] == ["b", "a"]
    assert con.execute(p.key_query("it's", "")).fetchall() == []


@pytest.mark.parametrize("n_cuts", [0, 1, 5])
def test_ranges_miss_and_double_nothing(n_cuts):
    rnd = random.Random(n_cuts)
    rows = sorted({(rnd.randrange(6), rnd.randrange(50)) for _ in range(120)})
    cuts = sorted(rnd.sample(rows, n_cuts))
    con = duckdb.connect()
    con.execute("CREATE TABLE t (a INT, b INT)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    parts = [
        con.execute(f"SELECT a, b FROM t WHERE {predicate} ORDER BY a, b").fetchall()
        for predicate in p.range_predicates(["a", "b"], cuts, "postgres")
    ]
    assert len(parts) == n_cuts + 1
    assert [r for part in parts for r in part] == rows


def test_text_is_compared_by_code():
    got = p.range_predicates(["k"], [("b",), ("O'x",)], "sqlserver")
    collate = '"k" COLLATE Latin1_General_100_BIN2'
    assert got == [
        f"{collate} < N'O''x'",
        f"{collate} >= N'O''x' AND {collate} < N'b'",
        f"{collate} >= N'b'",
    ]
    assert p.before(["k"], ["x"], "postgres") == '"k" COLLATE "C" < \'x\''


def test_cuts_follow_the_order_of_the_database():
    """UTF-16 puts characters beyond the first plane before U+E000; UTF-8 after."""
    low, high = "\U0001f600", "￮"
    first = p.range_predicates(["k"], [(low,), (high,)], "sqlserver")[0]
    assert low in first
    assert high in p.range_predicates(["k"], [(low,), (high,)], "postgres")[0]


def test_keys_that_cannot_be_written():
    with pytest.raises(TypeError):
        p.literal(b"x", "postgres")
    with pytest.raises(TypeError):
        p.literal(True, "postgres")


class Recorded(JdbcSource):
    """Reads a DataFrame in place of a database, noting what is asked of it."""

    def read(self, table, schema=None):
        return self.extra["df"]

    def read_strided(self, table, schema, column):
        self.extra["log"].append(("strided", column))
        return self.extra["df"]

    def read_ranges(self, table, schema, predicates):
        self.extra["log"].append(("ranges", list(predicates)))
        return self.extra["df"]

    def key_types(self, table, schema, keys):
        return self.extra.get("types", {})


def test_paged_read(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    source = Recorded(spark, "postgres", "u", "d", rows_per_range=300, extra={"df": df, "log": []})
    paged = source.read_paged("t", None, ["k"], 100)
    assert {r["_chunk_id"]: r["count"] for r in paged.groupBy("_chunk_id").count().collect()} == {
        i: 100 for i in range(10)
    }
    strided, ranges = source.extra["log"]
    assert strided == ("strided", "k")
    assert ranges[1] == [
        '"k" < 300', '"k" >= 300 AND "k" < 600', '"k" >= 600 AND "k" < 900', '"k" >= 900',
    ]


def test_paged_read_by_columns_that_are_no_key(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as v")
    source = Recorded(spark, "postgres", "u", "d", extra={"df": df, "log": []})
    paged = source.read_paged("t", None, ["k"], 100)
    assert paged.columns == ["k", "v", "_chunk_id"]
    assert {r["_chunk_id"]: r["count"] for r in paged.groupBy("_chunk_id").count().collect()} == {
        i: 100 for i in range(10)
    }
    assert [kind for kind, _ in source.extra["log"]] == ["strided"]


def test_more_ranges_than_pages(spark):
    df = spark.range(25).withColumnRenamed("id", "k")
    source = Recorded(spark, "sqlserver", "u", "d", rows_per_range=1, extra={"df": df, "log": []})
    source.read_paged("t", None, ["k"], 10)
    assert source.extra["log"][1][1] == ['"k" < 10', '"k" >= 10 AND "k" < 20', '"k" >= 20']


@pytest.mark.parametrize(
    "kind, db_type, side",
    [
        ("postgres", "uuid", '"k"'),
        ("sqlserver", "uniqueidentifier", 'CONVERT(CHAR(36), "k") COLLATE Latin1_General_100_BIN2'),
        ("postgres", "character varying", '"k" COLLATE "C"'),
    ],
)
def test_text_keys_are_read_in_parts_and_ranges(spark, kind, db_type, side):
    df = spark.range(40).selectExpr("lpad(id, 8, '0') || '-0000' as k")
    extra = {"df": df, "log": [], "types": {"k": db_type}}
    source = Recorded(spark, kind, "u", "d", connections=3, rows_per_range=20, extra=extra)
    paged = source.read_paged("t", None, ["k"], 10)
    assert paged.where("_chunk_id = 3").count() == 10
    (_, dealt), (_, ranges) = extra["log"]
    assert len(dealt) == 3
    mark = "N'" if kind == "sqlserver" else "'"
    assert ranges == [f"{side} < {mark}00000020-0000'", f"{side} >= {mark}00000020-0000'"]


def test_hash_predicates_deal_out_every_row_once():
    con = duckdb.connect()
    con.execute("CREATE MACRO hashtext(x) AS CASE WHEN x IS NOT NULL THEN (hash(x) % 4294967296)::BIGINT - 2147483648 END")
    con.execute("CREATE TABLE t AS SELECT CASE WHEN i % 9 > 0 THEN 'k' || i END AS k FROM range(200) r(i)")
    n = [con.execute(f"SELECT COUNT(*) FROM t WHERE {q}").fetchone()[0] for q in p.hash_predicates("k", 4, "postgres")]
    assert sum(n) == 200 and min(n) > 0
    assert p.hash_predicates('a"b', 2, "sqlserver")[1] == 'COALESCE(ABS(CAST(CHECKSUM("a""b") AS BIGINT)) % 2, 0) = 1'


def test_postgres_keys_come_from_its_own_catalog():
    sql = p.key_query("t", None, "postgres")
    assert "pg_index" in sql and "indisprimary" in sql and "information_schema" not in sql
    assert "n.nspname = 'raw'" in sql and "WITH ORDINALITY" in sql
    assert "pg_table_is_visible" in p.key_query("t", "", "postgres")
    assert "information_schema.table_constraints" in p.key_query("t", None, "sqlserver")


def test_settings_go_before_fixed_values(spark):
    source = JdbcSource(
        spark, "sqlserver", "u/", "d", write_connections=8, write_batch=50, extra={"fetchsize": "7", "batchsize": "9"}
    )
    opts = source.write_options("t")
    assert (opts["numPartitions"], opts["batchsize"], opts["fetchsize"]) == ("8", "9", "7")
    assert source.with_database("x").database == "x"
    assert JdbcSource(spark, "postgres", "u", "d", database="own").with_database("x").database == "own"
