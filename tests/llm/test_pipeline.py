"""The pipeline's stages against plain versions, each on what the one before kept."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from tidemark.llm import packing, secret_scan, simhash, toxicity
from tidemark.workspace import materialise
from test_secret_scan import plain_base
from test_simhash import plain_fingerprint, plain_groups


def kept_ids(rows):
    """The smallest id of each group; of rows that repeat an id, one."""
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in rows]
    return {c for c in plain_groups(prints, 4)}


def test_stages_on_documents(spark, sf_dir, documents):
    (_, toxic), (_, near), (_, secrets), (_, pack) = corpus_pipeline.STAGES
    model = toxicity.fit(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = model.scorer()
    rows = documents.collect()
    clean = materialise(toxic(spark, documents, sf_dir), "test")
    assert clean.schema == documents.schema
    assert {tuple(r) for r in clean.collect()} == {tuple(r) for r in rows if score(r.text) < 0.7}

    single = materialise(near(spark, clean, sf_dir), "test")
    assert single.schema == documents.schema
    want = kept_ids(clean.collect())
    assert {tuple(r) for r in single.collect()} == {tuple(r) for r in clean.collect() if r.doc_id in want}

    masked = materialise(secrets(spark, single, sf_dir), "test")
    assert masked.schema == documents.schema and masked.count() == single.count()
    before = {r.doc_id: r for r in single.collect()}
    added = {r.doc_id: r.added for r in secret_scan.scan_secrets(single).collect()}
    for r in masked.collect():
        old = before[r.doc_id]
        text, at = "", 0
        for a, b in merged([(a, b) for a, _, b in plain_base(old.text)] + [(s["start"], s["end"]) for s in added[r.doc_id]]):
            text += old.text[at:a] + "[secret]"
            at = b
        assert r.text == text + old.text[at:]
        assert r.n_chars == len(r.text) and (r.lang, r.source) == (old.lang, old.source)

    pieces = pack(spark, masked, sf_dir)
    whole = entry_point.queries()["pipeline"](spark, sf_dir)
    assert sorted(map(tuple, pieces.select("doc_id", "start", "doc_tokens").where("start = 0").collect())) == sorted(
        map(tuple, whole.select("doc_id", "start", "doc_tokens").where("start = 0").collect())
    )
    total = pieces.agg(F.sum("length"), F.max(F.col("sequence_id") * 2048 + F.col("offset") + F.col("length"))).first()
    assert total[0] == total[1] == sum(r.doc_tokens for r in pieces.where("start = 0").collect())
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in masked.collect()}


def merged(spans):
    out = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


@pytest.fixture(scope="module")
def odd_rows(odd_docs):
    """With columns whose names the operators use themselves."""
    return odd_docs.withColumns({c: F.lit(1) for c in ("bits", "root", "head_id", "base", "row", "digest", "count", "part")})


def test_odd_documents_pass_every_stage(spark, sf_dir, odd_rows):
    docs = odd_rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = materialise(stage(spark, docs, sf_dir), "test")
        assert after.columns == odd_rows.columns, name
        docs = after
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= docs.count() > 0


def test_no_documents_pass_every_stage(spark, sf_dir, documents):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "test")
        assert docs.count() == 0


def test_one_of_each_group_stays(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(5, text, "a"), (3, text, "b"), (3, text, "b"), (3, text.upper(), "c"), (None, text, "d"), (9, "else " * 9, "e")]
    rows += [(None, "only nulls here", "f"), (None, "only nulls here", "g"), (8, None, "h"), (7, "", "i")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in kept) == [(False, 3), (False, 7), (False, 9), (True, None)]
    assert next(r for r in kept if r.doc_id == 3).source in "bc"


def test_nothing_is_lost_in_packing(spark, documents):
    packed = packing.pack(documents, corpus_pipeline.public_tokenizers.path("word_bpe_49k.json"))
    n = packed.pieces().groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("m"))
    assert n.where("n != m").count() == 0 and n.count() == documents.count()


def test_no_keys_of_fingerprints_go_to_the_driver(spark, sf_dir, documents, plan_of, monkeypatch):
    plans, links = [], simhash.close_links

    def seen(*args):
        plans.append(plan_of(links(*args), "simple"))
        return links(*args)

    monkeypatch.setattr(simhash, "close_links", seen)
    corpus_pipeline.drop_near_copies(spark, documents.limit(100), sf_dir)
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]
