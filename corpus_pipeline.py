"""The stages that turn documents into packed training sequences.

Each stage takes the documents that the one before it kept, written as Parquet
and read again, and all but the last return their columns: toxic documents go,
one document of each group of near duplicates stays, secrets are masked, and
what is left is packed.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import packing, secret_scan, simhash, toxicity
from tidemark.llm.frames import unused_name
from tidemark.workspace import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that a model learned from the labels below ``sf_dir`` doesn't call toxic."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = unused_name(docs, "score")
    return model.score(docs, name=score).where(F.col(score) < TOXIC_FROM).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return simhash.keep_one(docs, words=4, distance=4)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mask in place of each secret; ``n_chars`` is the length of what is left."""
    found = secret_scan.scan_secrets(docs, carry=True)
    text = secret_scan.masked(F.col("row.text"), F.concat("base", "added"))
    rows = found.select(*[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
    if "n_chars" not in docs.columns:
        return rows
    kind = docs.schema["n_chars"].dataType
    return rows.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents that fill sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), length=2048, end_id=1).pieces()


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("secret scan", mask_secrets),
    ("packing", pack_documents),
]

# Classifiers, fingerprints, randomness tests and tokens can't be written as SQL;
# the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, for the documents below ``sf_dir``."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        rows = materialise(stage(spark, rows, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, rows, sf_dir)
