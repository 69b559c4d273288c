"""The registered queries: what they return, and what their plans must not contain."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point

QUERIES = {k: q for k, q in entry_point.queries().items() if k == "pipeline" or k[:2] == "op" and k[2].isdigit()}

COLUMNS = {
    "op1": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op2": "doc_id bigint, fingerprint string, component_id bigint",
    "op3": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op4": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op5": "doc_id bigint, n_sentences bigint, licences string, spans string",
    "op6": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op7": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8": "doc_id bigint, n_tokens bigint, ids_crc32 bigint, round_trip boolean",
    "op9": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op10": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, base_sha256 string, spans string",
    "op11": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    "op12": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
    "op13": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
}
COLUMNS["pipeline"] = COLUMNS["op4"]


def test_each_operator_has_its_query():
    assert sorted(k.split("_")[0] for k in QUERIES) == sorted(COLUMNS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, plan_of, name):
    df = QUERIES[name](spark, sf_dir)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == COLUMNS[name.split("_")[0]]
    plan = plan_of(df, "simple")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    table = "embeddings" if name.split("_")[0] in ("op1", "op6", "op12") else "documents"
    rows = df.collect()
    if name.split("_")[0] not in ("op1", "op4", "op12", "pipeline"):
        assert len(rows) == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    assert rows


@pytest.mark.parametrize("name", sorted(k for k in entry_point.oracle_sql() if k in QUERIES))
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{os.path.join(sf_dir, 'embeddings.parquet')}')")
    result = con.execute(entry_point.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    got = sorted(tuple(r[c] for c in columns) for r in QUERIES[name](spark, sf_dir).collect())
    assert got == sorted(result.fetchall())
