"""The registered queries and the SQL each is checked against.

Every query reads whole test tables.  Those that write do so in a folder of
their own below the shared folder, and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.operators import chunking, history, keys, lookup, profiles, quality, stats
from tidemark.operators.page_index import PageIndex
from tidemark.plans import audit, extract, load
from tidemark.plans.snapshots import HistoryTable, load_snapshot
from tidemark.sinks import leases, tables
from tidemark.sinks.digests import DigestedTable
from tidemark.sinks.published import PublishedTable
from tidemark.sources.documents import DocumentSource
from tidemark.sources.files import FileSource, list_files
from tidemark.streaming import increments
from tidemark.workspace import run_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PAGE = 4000


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def _files(spark: SparkSession, sf_dir: str) -> FileSource:
    keys = {"orders": ["o_orderkey"], "events": ["event_id"], "lineitem": ["l_orderkey", "l_linenumber"]}
    return FileSource(spark, sf_dir, keys=keys)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- scans, projections, filters ------------------------------------------------


@query(
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"
    " WHERE o_orderstatus = 'F' AND o_totalprice > 100000"
)
def scan_filter_project(spark, sf_dir):
    orders = _files(spark, sf_dir).read("orders")
    matching = lookup.equal_to(orders, o_orderstatus="F").where(F.col("o_totalprice") > 100000)
    return lookup.project(matching, ["o_orderkey", "o_custkey", "o_totalprice"])


@query("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 5")
def sample_rows(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return lookup.sample_rows(orders, ["o_orderkey"])


_ALL_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) > 0 AS has_content FROM {t}" for t in _ALL_TABLES
    )
)
def file_listing(spark, sf_dir):
    files = list_files(spark, sf_dir)
    table = F.regexp_extract("path", r"/([^/]+)\.parquet", 1).alias("table_name")
    return files.groupBy(table).agg((F.sum("length") > 0).alias("has_content"))


# --- pages ----------------------------------------------------------------------


@query(
    "SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 4000 AS INT) AS _chunk_id"
    " FROM orders"
)
def page_rows(spark, sf_dir):
    paged = chunking.page_rows(_table(spark, sf_dir, "orders"), ["o_orderkey"], PAGE)
    return paged.select("o_orderkey", "_chunk_id")


@query(
    "SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 4000 AS INT) AS _chunk_id"
    " FROM orders"
)
def page_rows_kept_index(spark, sf_dir):
    """Orders that arrive in two loads, the second of which falls among the first: only its buckets are numbered again."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey")
    late = (F.col("o_orderkey") % 100 == 7) & (F.col("o_orderkey") % 5000 < 500)
    index = PageIndex(spark, run_dir(spark, "page-index"), ["o_orderkey"], rows_per_bucket=500)
    index.append(orders.where(~late))
    index.append(orders.where(late))
    return index.page_rows(orders, PAGE)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 250")
def page_offset_fetch(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return chunking.offset_fetch(orders, ["o_orderkey"], 250, 100)


@query(
    "SELECT o_orderkey, o_totalprice FROM (SELECT o_orderkey, o_totalprice,"
    " row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn, COUNT(*) OVER () AS n FROM orders) t"
    " WHERE rn > n // 2 AND rn <= n // 2 + n // 4"
)
def deep_offset_fetch(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    n = orders.count()
    deep = chunking.offset_fetch(orders, ["o_orderdate", "o_orderkey"], n // 2, n // 4, max_top_rows=0)
    return deep.select("o_orderkey", "o_totalprice")


@query(
    "SELECT _chunk_id, CAST(_chunk_id AS BIGINT) * 4000 AS row_offset, COUNT(*) AS n_rows FROM"
    " (SELECT CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 4000 AS INT) AS _chunk_id FROM orders) t"
    " GROUP BY _chunk_id"
)
def chunk_manifest(spark, sf_dir):
    paged = chunking.page_rows(_table(spark, sf_dir, "orders"), ["o_orderkey"], PAGE)
    return chunking.manifest(paged, PAGE)


@query(
    "SELECT _chunk_id, COUNT(*) AS n_rows, MIN(l_orderkey) AS first_key, MAX(l_orderkey) AS last_key FROM"
    " (SELECT l_orderkey, CAST((row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1) // 4000 AS INT)"
    " AS _chunk_id FROM lineitem) t GROUP BY _chunk_id"
)
def tied_key_pages(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber"]
    paged = _files(spark, sf_dir).read_paged("lineitem", None, keys, PAGE)
    return paged.groupBy("_chunk_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("l_orderkey").alias("first_key"),
        F.max("l_orderkey").alias("last_key"),
    )


@query(
    "SELECT event_id, CAST((row_number() OVER (ORDER BY event_type || '/' || lpad(event_id::VARCHAR, 12, '0')) - 1)"
    " // 4 AS INT) AS _chunk_id FROM events"
)
def text_key_pages(spark, sf_dir):
    """Thousands of pages by a text key whose values share long beginnings."""
    name = F.concat_ws("/", "event_type", F.lpad(F.col("event_id").cast("string"), 12, "0"))
    events = _table(spark, sf_dir, "events").select("event_id", name.alias("name"))
    return chunking.page_rows(events, ["name"], 4).select("event_id", "_chunk_id")


@query(
    "SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderstatus, o_orderdate, o_orderkey) - 1) // 5 AS INT)"
    " AS _chunk_id FROM orders"
)
def composite_key_pages(spark, sf_dir):
    """Thousands of pages by a key of three types, the first with few values."""
    keys = ["o_orderstatus", "o_orderdate", "o_orderkey"]
    return chunking.page_rows(_table(spark, sf_dir, "orders"), keys, 5).select("o_orderkey", "_chunk_id")


@query(
    "SELECT table_name, CAST(page AS INT) AS _chunk_id, page * 4000 AS row_offset,"
    " CASE WHEN n - page * 4000 < 4000 THEN n - page * 4000 ELSE 4000 END AS expected_rows FROM"
    " (SELECT table_name, n, unnest(range((n + 3999) // 4000)) AS page FROM"
    " (SELECT 'orders' AS table_name, COUNT(*) AS n FROM orders"
    " UNION ALL SELECT 'events', COUNT(*) FROM events) c) p"
)
def planned_pages(spark, sf_dir):
    counts = stats.table_counts({t: _table(spark, sf_dir, t) for t in ("orders", "events")})
    plan = chunking.chunk_plan(stats.chunk_decision(counts, PAGE), PAGE)
    return plan.select("table_name", "_chunk_id", "row_offset", "expected_rows")


@query(
    "SELECT o_orderkey, o_orderstatus, 0 AS _chunk_id FROM orders WHERE o_orderkey < 7500"
    " UNION ALL SELECT o_orderkey, o_orderstatus, 1 FROM orders WHERE o_orderkey >= 7500"
)
def union_pages(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    parts = [orders.where("o_orderkey < 7500"), orders.where("o_orderkey >= 7500")]
    return chunking.union_pages([chunking.tag_page(p, i) for i, p in enumerate(parts)])


# --- statistics and keys ----------------------------------------------------------


@query(
    "SELECT table_name, row_count, row_count * 1024 / 1048576.0e0 AS estimated_size_mb,"
    " (row_count * 1024 / 1048576.0e0 > 50 OR row_count > 100000) AS chunked,"
    " CAST((row_count + 99999) // 100000 AS BIGINT) AS num_chunks FROM"
    " (SELECT 'customer' AS table_name, COUNT(*) AS row_count FROM customer"
    " UNION ALL SELECT 'part', COUNT(*) FROM part UNION ALL SELECT 'orders', COUNT(*) FROM orders"
    " UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem UNION ALL SELECT 'events', COUNT(*) FROM events) t"
)
def table_stats(spark, sf_dir):
    names = ("customer", "part", "orders", "lineitem", "events")
    return stats.chunk_decision(stats.table_counts({t: _table(spark, sf_dir, t) for t in names}))


@query(
    "SELECT 'orders' AS table_name, 'o_orderkey' AS key_cols, COUNT(*) AS n_rows,"
    " COUNT(DISTINCT o_orderkey) AS n_distinct, COUNT(*) = COUNT(DISTINCT o_orderkey) AS is_key FROM orders"
    " UNION ALL SELECT 'lineitem', 'l_orderkey,l_linenumber', SUM(c)::BIGINT, COUNT(*), SUM(c) = COUNT(*)"
    " FROM (SELECT COUNT(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber) t"
)
def key_profile(spark, sf_dir):
    profiles = [
        stats.key_profile(_table(spark, sf_dir, t), keys, t)
        for t, keys in (("orders", ["o_orderkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]))
    ]
    return chunking.union_pages(profiles).drop("n_null")


@query("SELECT COUNT(*) AS n FROM lineitem")
def row_counts(spark, sf_dir):
    return stats.row_count(_table(spark, sf_dir, "lineitem"))


@query(
    "SELECT n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"
    " WHERE r.r_name = 'ASIA'"
)
def catalog_join(spark, sf_dir):
    nation, region = (_table(spark, sf_dir, t) for t in ("nation", "region"))
    wanted = lookup.equal_to(region, r_name="ASIA")
    return nation.join(wanted, nation.n_regionkey == wanted.r_regionkey).select("n_name", "r_name")


@query(
    "SELECT n_name AS column_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'"
)
def catalog_key_columns(spark, sf_dir):
    """Regions stand in for constraints, nations for the columns these use."""
    nation, region = (_table(spark, sf_dir, t) for t in ("nation", "region"))
    kind = F.when(F.col("r_name").startswith("A"), "UNIQUE").otherwise("PRIMARY KEY")
    named = [F.col("r_regionkey").alias("constraint_name"), F.lit("raw").alias("table_schema"), F.col("r_name").alias("table_name")]
    constraints = region.select(*named, kind.alias("constraint_type"))
    usage = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        *named, F.col("n_name").alias("column_name"), F.col("n_nationkey").alias("ordinal_position")
    )
    return stats.constraint_key_columns(constraints, usage, "EUROPE", "raw")


@query(
    "SELECT CASE WHEN COUNT(*) = COUNT(DISTINCT o_custkey) THEN 'o_custkey'"
    " WHEN COUNT(*) = COUNT(DISTINCT (o_custkey, o_orderdate)) THEN 'o_custkey,o_orderdate'"
    " WHEN COUNT(*) = COUNT(DISTINCT o_orderkey) THEN 'o_orderkey' END AS key_cols FROM orders"
)
def key_search(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    found = stats.find_key(orders, [["o_custkey"], ["o_custkey", "o_orderdate"], ["o_orderkey"]])
    return orders.limit(1).select(F.lit(",".join(found) if found else None).alias("key_cols"))


# The columns among which keys are looked for.
KEYED = {
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "lineitem": (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ),
    "events": ("event_id", "ts", "user_id", "event_type", "value", "props"),
    "conversations": ("conv_id", "turn", "role", "text"),
}


def _sql_keys(table: str, columns: tuple[str, ...]) -> str:
    """SQL that counts the distinct tuples of each set of up to three columns."""
    sets = [c for k in (1, 2, 3) for c in combinations(columns, k)]
    counts = ", ".join(f"COUNT(DISTINCT ({', '.join(c)})) AS k{i}" for i, c in enumerate(sets))
    lists = ", ".join("[" + ", ".join(f"'{x}'" for x in c) + "]" for c in sets)
    found = ", ".join(f"k{i} = n" for i in range(len(sets)))
    return (
        f"SELECT '{table}' AS table_name, unnest([{lists}]) AS cols, unnest([{found}]) AS is_key"
        f" FROM (SELECT COUNT(*) AS n, {counts} FROM {table}) c"
    )


@query(
    f"WITH s AS ({' UNION ALL '.join(_sql_keys(t, c) for t, c in KEYED.items())}), k AS (SELECT * FROM s WHERE is_key)"
    " SELECT table_name, array_to_string(cols, ',') AS key_cols, CAST(len(cols) AS INTEGER) AS n_cols FROM k WHERE NOT EXISTS"
    " (SELECT 1 FROM k p WHERE p.table_name = k.table_name AND len(p.cols) < len(k.cols) AND list_has_all(k.cols, p.cols))"
)
def key_discovery(spark, sf_dir):
    found = [keys.key_table(_table(spark, sf_dir, t), t, 3, c) for t, c in KEYED.items()]
    return chunking.union_pages(found)


@query(
    "SELECT r.r_name, n.n_name FROM (SELECT r_regionkey, list(n_nationkey) AS ks FROM region"
    " JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey) a"
    " JOIN region r ON r.r_regionkey = a.r_regionkey JOIN nation n ON list_contains(a.ks, n.n_nationkey)"
)
def array_member_join(spark, sf_dir):
    nation, region = (_table(spark, sf_dir, t) for t in ("nation", "region"))
    members = nation.groupBy("n_regionkey").agg(F.collect_set("n_nationkey").alias("ks"))
    indexed = region.join(members, region.r_regionkey == members.n_regionkey)
    joined = stats.join_on_member(
        indexed.select("r_name", "ks"), "ks", nation.select("n_nationkey", "n_name"), "n_nationkey"
    )
    return joined.select("r_name", "n_name")


# --- extraction -------------------------------------------------------------------


@query(
    "SELECT t AS table_name, n AS total_rows, x AS extracted_rows, n - x AS missing_rows,"
    " CASE WHEN n = x THEN 'ok' ELSE 'failed' END AS status FROM"
    " (SELECT 'orders' AS t, COUNT(*) AS n, COUNT(*) AS x FROM orders"
    " UNION ALL SELECT 'events', COUNT(*), COUNT(*) FILTER (WHERE event_id >= 100) FROM events) s"
)
def extract_audit(spark, sf_dir):
    return audit.reconcile_counts(*_expected_and_landed(spark, sf_dir))


@query(
    "SELECT COUNT(*) FILTER (WHERE n = x) AS succeeded, COUNT(*) FILTER (WHERE n <> x) AS failed FROM"
    " (SELECT COUNT(*) AS n, COUNT(*) AS x FROM orders"
    " UNION ALL SELECT COUNT(*), COUNT(*) FILTER (WHERE event_id >= 100) FROM events) s"
)
def extract_summary(spark, sf_dir):
    return audit.outcome_totals(audit.reconcile_counts(*_expected_and_landed(spark, sf_dir)))


def _expected_and_landed(spark, sf_dir):
    """Counts of two tables at the source and after a landing that lost some events."""
    orders, events = (_table(spark, sf_dir, t) for t in ("orders", "events"))
    path = run_dir(spark, "audited")
    tables.overwrite(orders, f"{path}/orders")
    tables.overwrite(events.where("event_id >= 100"), f"{path}/events")
    landed = {t: spark.read.parquet(f"{path}/{t}") for t in ("orders", "events")}
    return stats.table_counts({"orders": orders, "events": events}), stats.table_counts(landed)


@dataclass(frozen=True)
class _LosingSource(FileSource):
    """Counts all rows of a table but delivers no early events."""

    def read(self, table, schema=None, columns=None):
        rows = super().read(table, schema, columns)
        return rows.where("event_id >= 100") if table == "events" else rows

    def row_count(self, table, schema=None):
        return super().read(table, schema).count()


@query(
    "SELECT table_name, n AS total_rows, x AS extracted_rows, n - x AS missing_rows,"
    " CASE WHEN n = x THEN 'ok' ELSE 'partial' END AS status FROM"
    " (SELECT 'orders' AS table_name, COUNT(*) AS n, COUNT(*) AS x FROM orders"
    " UNION ALL SELECT 'events', COUNT(*), COUNT(*) FILTER (WHERE event_id >= 100) FROM events) s"
)
def extract_completeness(spark, sf_dir):
    """An extraction from a source that loses rows, where that is allowed."""
    keys = {"orders": ["o_orderkey"], "events": ["event_id"]}
    source = _LosingSource(spark, sf_dir, keys=keys)
    run = extract.extract_tables(source, ["orders", "events"], chunk_size=PAGE, allow_partial=True)
    return audit.completeness(run.audit)


@query(
    "SELECT table_name, n AS rows, (n > 4000 AND k) AS chunked,"
    " CASE WHEN n > 4000 AND k THEN (n + 3999) // 4000 END AS chunks, 'ok' AS status FROM ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS n, {t in ('orders', 'events', 'lineitem')} AS k FROM {t}"
        for t in _ALL_TABLES
    )
    + ") c"
)
def extract_tables(spark, sf_dir):
    run = extract.extract_tables(_files(spark, sf_dir), list(_ALL_TABLES), chunk_size=PAGE)
    return audit.report(run.audit).select("table_name", "rows", "chunked", "chunks", "status")


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate FROM lineitem"
)
def extract_large_table(spark, sf_dir):
    landed = extract.extract_table(_files(spark, sf_dir), "lineitem", chunk_size=PAGE)
    return landed.rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )


@query(
    "SELECT 'events' AS table_name, CAST(page AS INT) AS _chunk_id, page * 4000 AS row_offset,"
    " CASE WHEN n - page * 4000 < 4000 THEN n - page * 4000 ELSE 4000 END AS n_rows,"
    " CAST(NULL AS VARCHAR) AS error FROM"
    " (SELECT n, unnest(range((n + 3999) // 4000)) AS page FROM (SELECT COUNT(*) AS n FROM events) c) p"
)
def extracted_pages(spark, sf_dir):
    landed = extract.extract_table(
        _files(spark, sf_dir), "events", chunk_size=PAGE, force_chunking=True
    )
    return landed.pages().select("table_name", "_chunk_id", "row_offset", "n_rows", "error")


# --- quality ----------------------------------------------------------------------


@query(
    "SELECT 'event_id' AS column_name, COUNT(*) FILTER (WHERE event_id IS NULL) AS null_count FROM events"
    " UNION ALL SELECT 'event_type', COUNT(*) FILTER (WHERE nullif(event_type, 'error') IS NULL) FROM events"
    " UNION ALL SELECT 'user_id', COUNT(*) FILTER (WHERE nullif(user_id, 8) IS NULL) FROM events"
)
def null_profile(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
        F.nullif(F.col("user_id"), F.lit(8)).alias("user_id"),
    )
    return quality.null_profile(events)


_PROFILED = "(SELECT event_id, nullif(event_type, 'error') AS event_type, nullif(user_id, 8) AS user_id FROM events)"


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT({c}) AS n_null,"
    f" CAST(MIN({c}) AS VARCHAR) AS low, CAST(MAX({c}) AS VARCHAR) AS high FROM {_PROFILED} e"
    for c in ("event_id", "event_type", "user_id")
))
def null_profile_merged(spark, sf_dir):
    """Events that arrive in two drops, of which the first is written anew: each file is profiled once."""
    events = _table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
        F.nullif(F.col("user_id"), F.lit(8)).alias("user_id"),
    )
    place = run_dir(spark, "profiles")
    kept = profiles.KeptProfiles(spark, f"{place}/kept", f"{place}/drop", events.schema)
    early = events.where("event_id % 3 <> 0")
    for rows, part in ((events, "early"), (early, "early"), (events.where("event_id % 3 = 0"), "late")):
        rows.write.mode("overwrite").parquet(f"{place}/drop/{part}")
        kept.update()
    return kept.merged().drop("n_distinct")


@query("SELECT DISTINCT l_returnflag AS code, l_linestatus AS subcode FROM lineitem")
def distinct_pairs(spark, sf_dir):
    return quality.code_pairs(_table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")


@query(
    "SELECT event_id, CASE WHEN t IS NULL OR t IN ('NULL', 'None') THEN '' ELSE t END AS norm FROM"
    " (SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN 'NULL'"
    " WHEN 'signup' THEN 'None' ELSE event_type END AS t FROM events) s"
)
def null_token_normalise(spark, sf_dir):
    kind = F.col("event_type")
    written = (
        F.when(kind == "error", F.lit(None))
        .when(kind == "view", "NULL")
        .when(kind == "signup", "None")
        .otherwise(kind)
    )
    events = _table(spark, sf_dir, "events").select("event_id", written.alias("t"))
    return events.select("event_id", scalars.blank_null_tokens(F.col("t")).alias("norm"))


def _expected_codes(spark):
    return spark.createDataFrame([("A", "F"), ("N", "O"), ("R", "X")], "code string, subcode string")


def _line_codes(spark, sf_dir):
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("code"), F.col("l_linestatus").alias("subcode")
    )


@query(
    "SELECT COALESCE(e.code, a.code) AS code, COALESCE(e.subcode, a.subcode) AS subcode,"
    " CASE WHEN e.code IS NULL THEN 'new' WHEN a.code IS NULL THEN 'missing' ELSE 'matched' END AS status"
    " FROM (SELECT DISTINCT l_returnflag AS code, l_linestatus AS subcode FROM lineitem) a"
    " FULL OUTER JOIN (VALUES ('A', 'F'), ('N', 'O'), ('R', 'X')) e(code, subcode)"
    " ON a.code = e.code AND a.subcode = e.subcode"
)
def code_reconcile(spark, sf_dir):
    return quality.reconcile_codes(_line_codes(spark, sf_dir), _expected_codes(spark))


@query(
    "SELECT COUNT(*) FILTER (WHERE a.code IS NOT NULL AND e.code IS NOT NULL) AS matched,"
    " COUNT(*) FILTER (WHERE e.code IS NULL) AS new, COUNT(*) FILTER (WHERE a.code IS NULL) AS missing,"
    " CASE WHEN COUNT(*) FILTER (WHERE e.code IS NULL OR a.code IS NULL) = 0 THEN 'match' ELSE 'mismatch' END"
    " AS status FROM (SELECT DISTINCT l_returnflag AS code, l_linestatus AS subcode FROM lineitem) a"
    " FULL OUTER JOIN (VALUES ('A', 'F'), ('N', 'O'), ('R', 'X')) e(code, subcode)"
    " ON a.code = e.code AND a.subcode = e.subcode"
)
def code_status(spark, sf_dir):
    return quality.code_status(code_reconcile(spark, sf_dir))


_NAMES = "(VALUES (1, 'page='), (2, '#top'), (3, 'ref='), (4, 'zzz'))"
_BASE_NAMES = "(SELECT page_id, regexp_extract(url, '[^/]*$') AS base_name FROM pages)"
_FIRST_MATCH = (
    f"SELECT f.page_id, f.base_name, e.pattern FROM {_BASE_NAMES} f LEFT JOIN {_NAMES} e(ord, pattern)"
    " ON contains(f.base_name, e.pattern)"
    " QUALIFY row_number() OVER (PARTITION BY f.page_id ORDER BY e.ord) = 1"
)
_FOUND_NAMES = (
    f"SELECT e.pattern, COUNT(m.page_id) AS n_files, COUNT(m.page_id) = 0 AS missing FROM {_NAMES}"
    " e(ord, pattern) LEFT JOIN (SELECT f.page_id, MIN(x.ord) AS ord FROM"
    f" {_BASE_NAMES} f JOIN {_NAMES} x(ord, pattern) ON contains(f.base_name, x.pattern)"
    " GROUP BY f.page_id) m ON m.ord = e.ord GROUP BY e.pattern"
)


def _expected_names(spark):
    rows = [(1, "page="), (2, "#top"), (3, "ref="), (4, "zzz")]
    return spark.createDataFrame(rows, "ord int, pattern string")


@query(_FIRST_MATCH)
def name_reconcile(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return quality.reconcile_names(pages, "url", _expected_names(spark), keep=["page_id"])


# The last six characters of every page's name, numbered in reverse order.
_ENDINGS = (
    "(SELECT row_number() OVER (ORDER BY ending DESC) AS ord, ending AS pattern FROM"
    f" (SELECT DISTINCT right(base_name, 6) AS ending FROM {_BASE_NAMES} b))"
)


@query(_FIRST_MATCH.replace(f"{_NAMES} e(ord, pattern)", f"{_ENDINGS} e"))
def name_reconcile_long_list(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    endings = pages.select(F.right(scalars.base_name(F.col("url")), F.lit(6)).alias("pattern")).distinct()
    place = F.row_number().over(Window.orderBy(F.desc("pattern"))).alias("ord")  # one row per ending
    return quality.reconcile_names(pages, "url", endings.select(place, "pattern"), keep=["page_id"])


_FEW, _DEAR = "l_linenumber <= 3", "l_quantity > 20"


@query(
    "WITH a AS (SELECT l_returnflag AS code, l_linestatus AS subcode, l_linenumber AS line FROM lineitem WHERE "
    f"{_FEW}), b AS (SELECT l_returnflag AS code, l_linestatus AS subcode, l_linenumber AS line FROM lineitem WHERE {_DEAR})"
    " SELECT 'left' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) x"
    " UNION ALL SELECT 'right', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) y"
)
def bag_difference(spark, sf_dir):
    codes = _table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("code"), F.col("l_linestatus").alias("subcode"), F.col("l_linenumber").alias("line"), "l_quantity"
    )
    left, right = codes.where("line <= 3"), codes.where(_DEAR)
    return quality.bag_difference(left.drop("l_quantity"), right.drop("l_quantity"))


# The first and the last six characters of every page's name; their places repeat and are settled by the text.
_PARTS = (
    "(SELECT DISTINCT -ascii(substr(p, 3, 1)) AS ord, p AS pattern FROM"
    f" (SELECT unnest([left(base_name, 6), right(base_name, 6)]) AS p FROM {_BASE_NAMES} b))"
)


@query(
    f"SELECT f.page_id, f.base_name, e.pattern FROM {_BASE_NAMES} f LEFT JOIN {_PARTS} e ON contains(f.base_name, e.pattern)"
    " QUALIFY row_number() OVER (PARTITION BY f.page_id ORDER BY e.ord, e.pattern) = 1"
)
def name_reconcile_shared_parts(spark, sf_dir):
    """A long list in which many patterns share their beginning or their ending."""
    pages = _table(spark, sf_dir, "pages")
    name = scalars.base_name(F.col("url"))
    parts = pages.select(F.explode(F.array(F.left(name, F.lit(6)), F.right(name, F.lit(6)))).alias("pattern")).distinct()
    place = -F.ascii(F.substring("pattern", 3, 1))
    return quality.reconcile_names(pages, "url", parts.select(place.alias("ord"), "pattern"), keep=["page_id"], max_tested=0)


@query(_FOUND_NAMES)
def name_reconcile_summary(spark, sf_dir):
    return quality.names_found(name_reconcile(spark, sf_dir), _expected_names(spark))


@query(
    "SELECT 4::BIGINT AS expected_count, l.n AS latest_count, l.n - m.matched AS new_files,"
    " m.missing AS missing_files, CASE WHEN l.n <> 4 OR m.missing > 0 THEN 'mismatch' ELSE 'match' END"
    " AS status FROM (SELECT COUNT(*) AS n FROM pages) l,"
    f" (SELECT SUM(n_files)::BIGINT AS matched, COUNT(*) FILTER (WHERE missing) AS missing FROM ({_FOUND_NAMES}) s) m"
)
def name_status(spark, sf_dir):
    return quality.name_status(name_reconcile(spark, sf_dir), _expected_names(spark))


@query(
    "SELECT string_agg(l_returnflag || ' ' || l_linestatus, ', ' ORDER BY l_returnflag, l_linestatus)"
    " AS summary FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem) t"
)
def mismatch_text(spark, sf_dir):
    pairs = quality.code_pairs(_table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")
    return quality.mismatch_text(pairs, ["code", "subcode"], items_per_line=1000).select("summary")


@query(
    "SELECT line, string_agg(o_custkey::VARCHAR, ', ' ORDER BY o_custkey) AS summary FROM"
    " (SELECT o_custkey, CAST((row_number() OVER (ORDER BY o_custkey) - 1) // 100 AS INT) AS line FROM"
    " (SELECT DISTINCT o_custkey FROM orders) d) t GROUP BY line"
)
def mismatch_text_lines(spark, sf_dir):
    customers = _table(spark, sf_dir, "orders").select("o_custkey").distinct()
    return quality.mismatch_text(customers, ["o_custkey"], items_per_line=100)


# --- look-ups and scalars -----------------------------------------------------------


@query("SELECT event_id, ts, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def latest_record(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return lookup.latest_record(events, "ts", "event_id")


@query(
    "SELECT event_id, user_id FROM events WHERE value > 10"
    " AND nullif(event_type, 'error') IS NOT DISTINCT FROM NULL ORDER BY event_id"
)
def active_jobs(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    name = F.nullif(F.col("event_type"), F.lit("error"))
    jobs = lookup.active_jobs(events, F.col("value") > 10, name, None, "event_id")
    return jobs.select("event_id", "user_id")


@query(
    "SELECT o_orderkey, 'drop/run_' || strftime(o_orderdate - INTERVAL 1 DAY, '%m%d%Y') AS prefix FROM orders"
)
def dated_prefix(spark, sf_dir):
    prefix = scalars.dated_prefix("drop/run_", F.col("o_orderdate"), 1, "MMddyyyy")
    return _table(spark, sf_dir, "orders").select("o_orderkey", prefix.alias("prefix"))


@query("SELECT event_id, epoch_us(ts) // 1000 + event_id % 50 AS synth_id FROM events")
def millis_id(spark, sf_dir):
    synth = scalars.millis_id(F.col("ts"), F.col("event_id") % 50)
    return _table(spark, sf_dir, "events").select("event_id", synth.alias("synth_id"))


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_extendedprice AS DECIMAL(12,2))"
    " * CAST(l_quantity AS DECIMAL(6,0)) AS DECIMAL(18,2)) AS amount FROM lineitem"
)
def line_amount(spark, sf_dir):
    amount = scalars.line_amount(F.col("l_extendedprice"), F.col("l_quantity"))
    return _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", amount.alias("amount")
    )


@query("SELECT event_id, CAST(props ->> '$.k' AS INT) AS k FROM events")
def nested_field(spark, sf_dir):
    k = scalars.json_field(F.col("props"), "$.k", "int")
    return _table(spark, sf_dir, "events").select("event_id", k.alias("k"))


@query(
    "SELECT event_id, event_type FROM (SELECT event_id, nullif(event_type, 'error') AS event_type, row_number() OVER"
    " (PARTITION BY nullif(event_type, 'error') ORDER BY left(md5(event_id::VARCHAR), 15), event_id) AS place FROM events) e"
    " WHERE place <= 25"
)
def stratified_sample(spark, sf_dir):
    """Twenty-five events of each type, and of those without one, by a hash that SQL has as well."""
    kind = F.nullif(F.col("event_type"), F.lit("error")).alias("event_type")
    events = _table(spark, sf_dir, "events").select("event_id", kind)
    draw = F.conv(F.left(F.md5(F.col("event_id").cast("string")), F.lit(15)), 16, 10).cast("bigint")
    return lookup.sample_per_group(events, ["event_type"], ["event_id"], 25, draw)


@query(
    "SELECT event_type, k, n, first_id, total, high FROM (SELECT event_type, CAST(props ->> '$.k' AS INTEGER) AS k,"
    " COUNT(*) AS n, MIN(event_id) AS first_id, CAST(SUM(event_id) AS BIGINT) AS total, MAX(value) AS high FROM events"
    " WHERE event_type IN ('view', 'purchase', 'click') AND value > 10 AND user_id <> 8 GROUP BY ALL) g"
    " ORDER BY n DESC, event_type, k LIMIT 40 OFFSET 3"
)
def document_pipeline(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select(
        F.col("event_id").alias("_id"), "user_id", "event_type", "value", F.from_json("props", "k int").alias("props")
    )
    store = DocumentSource(spark, run_dir(spark, "event-documents"))
    store.overwrite(events, "events")
    pipeline = """[
        {"$match": {"event_type": {"$in": ["view", "purchase", "click"]}, "value": {"$gt": 10}, "user_id": {"$ne": 8}}},
        {"$group": {"_id": {"event_type": "$event_type", "k": "$props.k"}, "n": {"$sum": 1},
                    "first_id": {"$min": "$_id"}, "total": {"$sum": "$_id"}, "high": {"$max": "$value"}}},
        {"$sort": {"n": -1, "_id.event_type": 1, "_id.k": 1}},
        {"$skip": 3},
        {"$limit": 40},
        {"$project": {"_id": 0, "event_type": "$_id.event_type", "k": "$_id.k", "n": 1, "first_id": 1, "total": 1, "high": 1}}
    ]"""
    made = "event_type string, k int, n bigint, first_id bigint, total bigint, high double"
    return store.read_as("events", made, pipeline, stored=events.schema)


@query(
    "SELECT d.day, COUNT(e.event_id) AS n_events FROM"
    " (SELECT unnest(generate_series(DATE '2023-12-30', DATE '2024-02-02', INTERVAL 1 DAY))::DATE AS day) d"
    " LEFT JOIN events e ON CAST(e.ts AS DATE) = d.day GROUP BY d.day"
)
def day_series(spark, sf_dir):
    series = scalars.days_between(F.lit("2023-12-30").cast("date"), F.lit("2024-02-02").cast("date"))
    days = spark.range(1).select(series.alias("day"))
    per_day = _table(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("day")).count()
    n_events = F.coalesce(F.col("count"), F.lit(0).cast("bigint"))
    return days.join(per_day, "day", "left").select("day", n_events.alias("n_events"))


@query("SELECT c_custkey FROM customer WHERE c_custkey * 31 % 100 < 5")
def hash_sample(spark, sf_dir):
    bucket = F.pmod(F.col("c_custkey") * 31, F.lit(100))
    return lookup.hash_sample(_table(spark, sf_dir, "customer"), 5, bucket).select("c_custkey")


@query("SELECT COUNT(*) * 5 // 100 AS n, COUNT(*) * 5 // 100 AS n_distinct FROM customer")
def fixed_size_sample(spark, sf_dir):
    customers = _table(spark, sf_dir, "customer")
    drawn = lookup.fixed_size_sample(customers, "c_custkey", customers.count() * 5 // 100)
    return drawn.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("c_custkey").alias("n_distinct"))


# --- documents ------------------------------------------------------------------------


@query("SELECT event_id, user_id, event_type, CAST(props ->> '$.k' AS INT) AS k FROM events")
def document_round_trip(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.struct(scalars.json_field(F.col("props"), "$.k", "int").alias("k")).alias("meta"),
    )
    store = DocumentSource(spark, run_dir(spark, "documents"))
    store.overwrite(events.where("event_id < 500"), "web_events")
    store.append(events.where("event_id >= 500"), "web_events")
    back = store.read_as("web_events", events.schema)
    return back.select("event_id", "user_id", "event_type", F.col("meta.k").alias("k"))


@query(
    "SELECT event_type, COUNT(*) AS n FROM events WHERE event_type <> 'error' GROUP BY event_type"
)
def document_inferred(spark, sf_dir):
    store = DocumentSource(spark, run_dir(spark, "documents"))
    store.overwrite(_table(spark, sf_dir, "events").select("event_id", "event_type"), "web_events")
    found = store.read("web_events").where(F.col("event_type") != "error")
    return found.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


# --- sinks ------------------------------------------------------------------------------


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def column_list_insert(spark, sf_dir):
    path = run_dir(spark, "inserted")
    columns = ["c_custkey", "c_name", "c_nationkey"]
    tables.insert_columns(_table(spark, sf_dir, "customer"), path, columns)
    return spark.read.parquet(path)


_RAISED = "CASE WHEN c_custkey % 20 = 0 THEN c_acctbal + 100 ELSE c_acctbal END"


def _raised():
    balance = F.col("c_acctbal")
    return F.when(F.col("c_custkey") % 20 == 0, balance + 100).otherwise(balance).alias("c_acctbal")


@query(f"SELECT c_custkey, c_name, {_RAISED} AS c_acctbal FROM customer")
def write_overwrite(spark, sf_dir):
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = run_dir(spark, "overwritten")
    tables.overwrite(customers, path)
    tables.overwrite(customers.select("c_custkey", "c_name", _raised()), path)
    return spark.read.parquet(path)


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def write_append(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = run_dir(spark, "appended")
    tables.append(orders.where("o_orderstatus = 'F'"), path)
    tables.append(orders.where("o_orderstatus <> 'F'"), path)
    return spark.read.parquet(path)


def _priced(parts, change):
    return parts.withColumn("p_retailprice", F.col("p_retailprice") + change)


@query("SELECT p_partkey, p_name, p_retailprice + 1 AS p_retailprice FROM part")
def staged_publish(spark, sf_dir):
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    table = PublishedTable(spark, run_dir(spark, "published"))
    table.publish(parts)
    table.publish(_priced(parts, 1))
    table.stage(_priced(parts, 2))
    return table.read()


@query("SELECT p_partkey, p_name, p_retailprice + 1 AS p_retailprice FROM part")
def flip_order(spark, sf_dir):
    """Two versions staged, and made live in the other order: the last flip counts."""
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    table = PublishedTable(spark, run_dir(spark, "published"))
    earlier, _ = table.stage(_priced(parts, 1))
    later, _ = table.stage(_priced(parts, 2))
    table.flip(later)
    table.flip(earlier, replaces=later)
    return table.read()


@query(
    "SELECT 'orders' AS table_name, COUNT(*) AS extracted_rows, 'ok' AS status FROM orders"
    " UNION ALL SELECT 'part', COUNT(*), 'ok' FROM part"
)
def run_log_append(spark, sf_dir):
    path = run_dir(spark, "run-log")
    for table in ("orders", "part"):
        run = extract.extract_tables(_files(spark, sf_dir), [table])
        audit.append_run_log(run.audit, path)
    return spark.read.parquet(path).select("table_name", "extracted_rows", "status")


# --- loads ----------------------------------------------------------------------------------

_CUT = datetime(2024, 1, 20)


@query("SELECT event_id, ts, event_type FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'")
def watermark_increment(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return load.after_watermark(events, "ts", load.mark(events, "ts", _CUT))


@query("SELECT event_id, ts, user_id, event_type FROM events")
def incremental_batches(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    path = run_dir(spark, "increments")
    first = events.where(F.col("ts") <= load.mark(events, "ts", _CUT))
    for arrived in (first, events, events):
        load.load_increment(arrived, path, "ts", ["event_id"], day_column="event_date")
    return spark.read.parquet(path).select("event_id", "ts", "user_id", "event_type")


@query(
    "SELECT nullif(event_id % 1000, 7) + event_id // 1000 * 1000 AS event_id, event_id AS place,"
    " CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS ts FROM events"
)
def incremental_with_nulls(spark, sf_dir):
    """Three loads of rows of which some have no key and some no time stamp."""
    key = F.nullif(F.col("event_id") % 1000, F.lit(7)) + F.call_function("div", F.col("event_id"), F.lit(1000)) * 1000
    stamp = F.when(F.col("event_type") != "error", F.col("ts"))
    events = _table(spark, sf_dir, "events").select(
        key.alias("event_id"), F.col("event_id").alias("place"), stamp.alias("ts"), F.col("ts").alias("at")
    )
    path = run_dir(spark, "increments")
    first = events.where(F.col("at") <= load.mark(events, "at", _CUT))
    for arrived in (first, events, events):
        load.load_increment(arrived.drop("at"), path, "ts", ["event_id"], lookback=timedelta(days=60))
    return spark.read.parquet(path)


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def incremental_by_day(spark, sf_dir):
    """A watermark of dates, which many rows share."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    path = run_dir(spark, "increments")
    half = orders.agg(F.percentile_approx(F.unix_date("day"), 0.5)).scalar()
    for arrived in (orders.where(F.unix_date("day") <= half), orders, orders):
        load.load_increment(arrived, path, "day", ["o_orderkey"])
    return spark.read.parquet(path)


@query("SELECT event_id, ts, user_id, event_type FROM events")
def incremental_full(spark, sf_dir):
    schema = _table(spark, sf_dir, "events").schema
    path, checkpoint = run_dir(spark, "streamed"), run_dir(spark, "stream-checkpoint")
    for _ in range(2):
        stream = increments.file_stream(spark, f"{sf_dir}/events*.parquet", schema)
        increments.append_available(stream, path, checkpoint, day_of="ts")
    return spark.read.parquet(path).select("event_id", "ts", "user_id", "event_type")


@query("SELECT 1 AS run, COUNT(*) AS n FROM events UNION ALL SELECT 2, 0")
def stream_counts(spark, sf_dir):
    """How many rows a stream appended, and that there is nothing left for the next run."""
    events = _table(spark, sf_dir, "events")
    path, checkpoint = run_dir(spark, "streamed"), run_dir(spark, "stream-checkpoint")
    counts = []
    for _ in range(2):
        stream = increments.file_stream(spark, f"{sf_dir}/events*.parquet", events.schema)
        counts.append(increments.rows_appended(increments.append_available(stream, path, checkpoint)))
    return spark.createDataFrame(list(enumerate(counts, 1)), "run int, n bigint")


_DROPS = ("event_id % 3 <> 0", "event_id % 2 = 0", "true")


def _stream_drops(spark, sf_dir):
    """Three drops that share events, each landed by a run of its own; the last run finds nothing new."""
    events = _table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    drops, path, checkpoint = (run_dir(spark, p) for p in ("drops", "streamed-once", "stream-checkpoint"))
    for i, part in enumerate((*_DROPS, None)):
        if part:
            events.where(part).write.parquet(f"{drops}/drop-{i}")
        stream = increments.file_stream(spark, f"{drops}/*", events.schema)
        increments.append_once(stream, path, checkpoint, ["event_id"], "ts")
    return path


@query("SELECT event_id, ts, user_id, event_type FROM events")
def stream_once(spark, sf_dir):
    path = _stream_drops(spark, sf_dir)
    return increments.landed_rows(spark, path).select("event_id", "ts", "user_id", "event_type")


@query(
    "WITH e AS (SELECT event_id AS id, ts, CASE WHEN event_id % 3 <> 0 THEN 0 WHEN event_id % 2 = 0 THEN 1 ELSE 2 END AS load"
    " FROM events), o AS (SELECT 0 AS load, COUNT(*) FILTER (WHERE id % 3 <> 0) AS offered FROM e UNION ALL"
    " SELECT 1, COUNT(*) FILTER (WHERE id % 2 = 0) FROM e UNION ALL SELECT 2, COUNT(*) FROM e)"
    " SELECT o.load::BIGINT AS load, offered, COUNT(*) AS landed, offered - COUNT(*) AS repeated,"
    " COUNT(*) FILTER (WHERE e.ts < (SELECT MAX(p.ts) FROM e p WHERE p.load < o.load)) AS late"
    " FROM o JOIN e ON e.load = o.load GROUP BY o.load, offered"
)
def stream_loads(spark, sf_dir):
    path = _stream_drops(spark, sf_dir)
    return increments.loads_of(spark, path).select("load", "offered", "landed", "repeated", "late")


@query(
    "SELECT event_id, ts, event_id % 7 = 0 AND ts < TIMESTAMP '2024-01-13 00:00:00' AS late FROM events"
)
def increment_late_rows(spark, sf_dir):
    """Rows held back from the first load: those beyond the lookback are set apart, once, the others land."""
    events = _table(spark, sf_dir, "events").select("event_id", "ts")
    path, late_path = run_dir(spark, "increments"), run_dir(spark, "late-rows")
    mark = spark.createDataFrame([(-1, _CUT)], "event_id bigint, ts timestamp_ntz")  # so that the mark is the cut itself
    first = events.where((F.col("event_id") % 7 != 0) & (F.col("ts") <= load.mark(events, "ts", _CUT)))
    for arrived in (first.unionByName(mark), events, events):
        load.load_increment(
            arrived, path, "ts", ["event_id"], lookback=timedelta(days=7), day_column="event_date", late_path=late_path
        )
    landed = spark.read.parquet(path).where("event_id >= 0").select("event_id", "ts", F.lit(False).alias("late"))
    return landed.unionByName(spark.read.parquet(late_path).select("event_id", "ts", F.lit(True).alias("late")))


def _customers(spark, sf_dir):
    return _table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")


def _new_customers(spark, sf_dir):
    """The next snapshot: some balances raised, some customers gone, some new."""
    customers = _customers(spark, sf_dir)
    kept = customers.where("c_custkey % 50 <> 7").select("c_custkey", _raised())
    arrived = customers.where("c_custkey < 5").withColumn("c_custkey", F.col("c_custkey") + 100000)
    return kept.unionByName(arrived)


def _stamped(df, day):
    return df.withColumn("last_modified", F.lit(day).cast("date"))


_UPSERTED = (
    f"SELECT c_custkey, {_RAISED} AS c_acctbal, CASE WHEN c_custkey % 20 = 0 THEN DATE '2024-01-21'"
    " ELSE DATE '2024-01-01' END AS last_modified FROM customer"
)


def _base_and_changes(spark, sf_dir):
    customers = _customers(spark, sf_dir)
    changed = customers.where("c_custkey % 20 = 0").select("c_custkey", _raised())
    return _stamped(customers, "2024-01-01"), _stamped(changed, "2024-01-21")


@query(_UPSERTED)
def snapshot_upsert(spark, sf_dir):
    base, changes = _base_and_changes(spark, sf_dir)
    return history.upsert(base, changes, ["c_custkey"], "last_modified")


@query(_UPSERTED)
def replace_by_key(spark, sf_dir):
    base, changes = _base_and_changes(spark, sf_dir)
    return history.sorted_snapshot(
        history.replace_by_key(base, changes, ["c_custkey"]), ["c_custkey"]
    )


@query(
    "WITH b AS (SELECT CASE WHEN c_custkey % 100 = 60 THEN NULL ELSE c_custkey END AS k, c_custkey AS place, c_acctbal AS v FROM customer),"
    f" c AS (SELECT CASE WHEN c_custkey % 100 = 60 THEN NULL ELSE c_custkey END AS k, c_custkey AS place, {_RAISED} AS v"
    " FROM customer WHERE c_custkey % 200 IN (40, 60)) SELECT k, place, v FROM b WHERE NOT EXISTS"
    " (SELECT 1 FROM c WHERE c.k IS NOT DISTINCT FROM b.k) UNION ALL SELECT k, place, v FROM c"
)
def replace_by_null_key(spark, sf_dir):
    """Rows of a null key are replaced like those of any other."""
    key = F.when(F.col("c_custkey") % 100 != 60, F.col("c_custkey")).alias("k")
    customers = _table(spark, sf_dir, "customer")
    place = F.col("c_custkey").alias("place")
    changed = customers.where("c_custkey % 200 IN (40, 60)").select(key, place, _raised().alias("v"))
    return history.replace_by_key(customers.select(key, place, F.col("c_acctbal").alias("v")), changed, ["k"])


_DIFF = (
    "SELECT COALESCE(a.k, b.k) AS c_custkey, CASE WHEN a.k IS NULL THEN 'insert' WHEN b.k IS NULL THEN 'delete'"
    " WHEN a.v IS DISTINCT FROM b.v THEN 'update' ELSE 'same' END AS op FROM"
    " (SELECT c_custkey AS k, c_acctbal AS v FROM customer) a FULL OUTER JOIN"
    f" (SELECT c_custkey AS k, {_RAISED} AS v FROM customer WHERE c_custkey % 50 <> 7"
    " UNION ALL SELECT c_custkey + 100000, c_acctbal FROM customer WHERE c_custkey < 5) b ON a.k = b.k"
)


@query(_DIFF)
def snapshot_diff(spark, sf_dir):
    return history.snapshot_diff(
        _customers(spark, sf_dir), _new_customers(spark, sf_dir), ["c_custkey"], new_repeats=True
    )


@query(_DIFF)
def snapshot_diff_by_digest(spark, sf_dir):
    old, new = _customers(spark, sf_dir), _new_customers(spark, sf_dir)
    return history.snapshot_diff(old, new, ["c_custkey"], by_digest=True, new_repeats=True)


@query(f"SELECT c_custkey, op FROM ({_DIFF}) d WHERE op <> 'same'")
def diff_of_versions(spark, sf_dir):
    """Two published versions compared by their digests, after the versions that nobody holds were removed."""
    customers = _customers(spark, sf_dir)
    table = DigestedTable(spark, run_dir(spark, "versions"), ["c_custkey"], buckets=64, fanout=16)
    table.publish(customers.where("c_custkey % 2 = 0"))
    old = table.publish(customers)
    with leases.held(table, old):
        new = table.publish(_new_customers(spark, sf_dir))
        leases.clean(table, keep=0)
    return table.diff(old, new, new_repeats=True)


@query(
    f"SELECT c_custkey, {_RAISED} AS c_acctbal FROM customer WHERE c_custkey % 50 <> 7"
    " UNION ALL SELECT c_custkey + 100000, c_acctbal FROM customer WHERE c_custkey < 5"
)
def snapshot_patch(spark, sf_dir):
    old, new = _customers(spark, sf_dir), _new_customers(spark, sf_dir)
    diff = history.snapshot_diff(old, new, ["c_custkey"], new_repeats=True)
    return history.apply_diff(old, diff, new, ["c_custkey"])


_HISTORY = (
    "SELECT c_custkey, c_acctbal, DATE '2024-01-01' AS valid_from, CASE WHEN c_custkey % 20 = 0 THEN"
    " DATE '2024-01-21' END AS valid_to, c_custkey % 20 <> 0 AS is_current FROM customer UNION ALL"
    " SELECT c_custkey, c_acctbal + 100, DATE '2024-01-21', NULL, TRUE FROM customer WHERE c_custkey % 20 = 0"
)


@query(_HISTORY)
def scd2_history(spark, sf_dir):
    customers = _customers(spark, sf_dir)
    opened = history.open_history(customers, F.lit("2024-01-01").cast("date"))
    later = customers.select("c_custkey", _raised())
    return history.extend_history(opened, later, ["c_custkey"], F.lit("2024-01-21").cast("date"))


@query(_HISTORY)
def scd2_loads(spark, sf_dir):
    customers = _customers(spark, sf_dir)
    table = HistoryTable(spark, run_dir(spark, "history"), ["c_custkey"])
    table.load(customers, F.lit("2024-01-01").cast("date"))
    table.load(customers.select("c_custkey", _raised()), F.lit("2024-01-21").cast("date"))
    return table.read()


@query(
    "SELECT c_custkey, c_acctbal, NULL AS c_mktsegment, TIMESTAMP '2024-01-21 08:00:00' AS valid_from,"
    " TIMESTAMP '2024-01-21 20:00:00' AS valid_to, FALSE AS is_current FROM customer UNION ALL"
    " SELECT c_custkey, c_acctbal, c_mktsegment, TIMESTAMP '2024-01-21 20:00:00', NULL, TRUE FROM customer"
    " WHERE c_custkey % 50 <> 7"
)
def scd2_two_loads_a_day(spark, sf_dir):
    """The second load of a day brings a new column and misses some customers."""
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    table = HistoryTable(spark, run_dir(spark, "history"), ["c_custkey"])
    at = lambda hour: F.lit(f"2024-01-21 {hour}:00:00").cast("timestamp_ntz")
    table.load(customers.drop("c_mktsegment"), at("08"))
    table.load(customers.where("c_custkey % 50 <> 7"), at("20"))
    return table.read()


_LATE_HISTORY = (
    "WITH s AS (SELECT c_custkey, c_acctbal AS v, CASE WHEN c_custkey % 50 <> 7 THEN c_acctbal +"
    " CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END END AS w, c_acctbal + CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS x"
    " FROM customer), d AS (SELECT c_custkey, DATE '2024-01-01' AS day, v FROM s UNION ALL"
    " SELECT c_custkey, DATE '2024-01-11', w FROM s UNION ALL SELECT c_custkey, DATE '2024-01-21', x FROM s),"
    " c AS (SELECT *, lag(v) OVER k AS before, row_number() OVER k AS i FROM d WINDOW k AS (PARTITION BY c_custkey ORDER BY day)),"
    " t AS (SELECT c_custkey, v, day, lead(day) OVER (PARTITION BY c_custkey ORDER BY day) AS till FROM c"
    " WHERE i = 1 OR v IS DISTINCT FROM before)"
    " SELECT c_custkey, v AS c_acctbal, day AS valid_from, till AS valid_to, till IS NULL AS is_current FROM t WHERE v IS NOT NULL"
)


@query(_LATE_HISTORY)
def scd2_late_snapshot(spark, sf_dir):
    """The second of three snapshots arrives last; some customers are missing in it."""
    customers = _customers(spark, sf_dir)
    raised = lambda n: (F.col("c_acctbal") + F.when(F.col("c_custkey") % n == 0, 1).otherwise(0)).alias("c_acctbal")
    second = customers.where("c_custkey % 50 <> 7").select("c_custkey", raised(3))
    table = HistoryTable(spark, run_dir(spark, "history"), ["c_custkey"])
    for snapshot, day in (
        (customers, "2024-01-01"), (customers.select("c_custkey", raised(4)), "2024-01-21"), (second, "2024-01-11")
    ):
        table.load(snapshot, F.lit(day).cast("date"))
    return table.read()


_WIDER_DIFF = (
    "SELECT a.c_custkey, CASE WHEN a.c_mktsegment IS NULL THEN 'same' ELSE 'update' END AS op FROM"
    " (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer) a"
)


@query(_WIDER_DIFF)
def snapshot_diff_new_column(spark, sf_dir):
    """A column that only the new snapshot has: rows with a value there have changed."""
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c_mktsegment")
    new = _table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", segment)
    return history.snapshot_diff(_customers(spark, sf_dir), new, ["c_custkey"])


@query(f"SELECT c_custkey, {_RAISED} AS c_acctbal FROM customer")
def snapshot_replace(spark, sf_dir):
    customers = _customers(spark, sf_dir)
    table = PublishedTable(spark, run_dir(spark, "snapshot"))
    load_snapshot(table, customers)
    load_snapshot(table, customers.select("c_custkey", _raised()), customers.count())
    return table.read()
