"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    direct_codes,
    license_scan,
    merkle,
    packing,
    pieces,
    rank_bpe,
    secret_scan,
    simhash,
    tokens,
    topk_search,
    toxicity,
    vector_dedup,
    whitening,
)
from tidemark.workspace import run_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op2_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=4, distance=4)
    return found.select("doc_id", "fingerprint", "component_id")


@query()
def op3_token_counts(spark, sf_dir):
    return tokens.token_counts(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024
    )


@query()
def op4_packing(spark, sf_dir):
    return packing.pack(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), length=2048, end_id=1
    ).pieces()


@query()
def op9_token_files(spark, sf_dir):
    path = run_dir(spark, "token-files")
    direct_codes.write_codes(
        _table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1
    )
    return direct_codes.read_documents(spark, path)


@query()
def op10_secret_scan(spark, sf_dir):
    return secret_scan.digest(secret_scan.scan_secrets(_table(spark, sf_dir, "documents")))


@query(
    """
    WITH v AS (
        SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
        FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.x) = len(q.x)
        WHERE q.vec_id % 50 = 0
    ), r AS (
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s
    )
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """
)
def op1_exact_top_k(spark, sf_dir):
    return topk_search.exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query()
def op6_embedding_near_dedup(spark, sf_dir):
    return vector_dedup.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.93)


@query()
def op5_license_scan(spark, sf_dir):
    return license_scan.digest(license_scan.scan_licences(_table(spark, sf_dir, "documents")))


@query()
def op7_toxicity(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, _table(spark, sf_dir, "labels"))
    return toxicity.toxicity(documents, model, threshold=0.7)


@query()
def op8_sentencepiece(spark, sf_dir):
    return pieces.checked_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op11_merkle_manifest(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    return merkle.checked(merkle.build(documents, carry=merkle.tampered(documents)).proofs())


@query()
def op12_embedding_whitening(spark, sf_dir):
    return whitening.digest(whitening.fit(_table(spark, sf_dir, "embeddings")).whitened(components=4))


@query()
def op13_bpe_codec(spark, sf_dir):
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    ids = rank_bpe.encode(_table(spark, sf_dir, "documents"), tokenizer)
    return rank_bpe.digest(rank_bpe.decode(ids, tokenizer))
