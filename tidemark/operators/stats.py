"""Row counts, the chunking rule, and which columns identify a row."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ordering import col
from tidemark.functions.scalars import page_count, size_mb, size_mb_of
from tidemark.functions.sizes import small_side
from tidemark.operators.chunking import DEFAULT_CHUNK_SIZE, check_chunk_size, union_pages

# Fixed value: tables estimated above this many megabytes are read in pages.
SIZE_THRESHOLD_MB = 50


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count, all counted in one job."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return union_pages(counted)


def chunk_decision(
    counts: DataFrame,
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    threshold_mb: float = SIZE_THRESHOLD_MB,
    force_chunking: bool = False,
) -> DataFrame:
    """Size estimate, whether to read in pages, and how many pages there are."""
    check_chunk_size(chunk_size)
    rows = F.col("row_count")
    return (
        counts.withColumn("estimated_size_mb", size_mb(rows))
        .withColumn(
            "chunked",
            F.lit(force_chunking)
            | (F.col("estimated_size_mb") > F.lit(threshold_mb))
            | (rows > F.lit(chunk_size)),
        )
        .withColumn("num_chunks", page_count(rows, chunk_size))
    )


def should_chunk(
    rows: int, chunk_size: int, threshold_mb: float = SIZE_THRESHOLD_MB, force: bool = False
) -> bool:
    """The rule of ``chunk_decision`` for one known count."""
    return rows > 0 and (force or size_mb_of(rows) > threshold_mb or rows > chunk_size)


def key_profile(df: DataFrame, keys: Sequence[str], table_name: str) -> DataFrame:
    """Whether ``keys`` identify every row: no nulls, no tuple twice.

    Copies of a key are folded into a count before the shuffle, so a hot key
    costs one row per task.
    """
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | col(k).isNull()
    per_key = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__copies"))
    totals = per_key.agg(
        F.coalesce(F.sum("__copies"), F.lit(0).cast("bigint")).alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.coalesce(F.sum(F.when(has_null, F.col("__copies"))), F.lit(0).cast("bigint")).alias("n_null"),
    )
    return totals.select(
        F.lit(table_name).alias("table_name"),
        F.lit(",".join(keys)).alias("key_cols"),
        "n_rows",
        "n_distinct",
        "n_null",
        ((F.col("n_rows") == F.col("n_distinct")) & (F.col("n_null") == 0)).alias("is_key"),
    )


def find_key(df: DataFrame, candidates: Iterable[Sequence[str]]) -> tuple[str, ...] | None:
    """The first candidate that identifies every row of ``df``."""
    for keys in candidates:
        if key_profile(df, keys, "").first()["is_key"]:
            return tuple(keys)
    return None


# --- key columns from a database catalog --------------------------------------


def constraint_key_columns(
    constraints: DataFrame, usage: DataFrame, table: str, schema: str
) -> DataFrame:
    """Primary key columns from constraint and column-usage catalogs, in key order."""
    wanted = constraints.where(
        (F.col("constraint_type") == "PRIMARY KEY")
        & (F.col("table_name") == table)
        & (F.col("table_schema") == schema)
    ).select("constraint_name", "table_schema", "table_name")
    return (
        wanted.join(usage, ["constraint_name", "table_schema", "table_name"])
        .orderBy("ordinal_position")
        .select("column_name")
    )


def join_on_member(
    left: DataFrame, members: str, right: DataFrame, key: str
) -> DataFrame:
    """Rows of ``right`` whose ``key`` is an element of the array ``members``.

    The array is unrolled, which turns the membership test into an equi-join
    that can be hashed or sorted instead of a comparison of every pair.
    """
    member = "__member"
    unrolled = left.withColumn(member, F.explode(F.array_distinct(col(members))))
    return unrolled.join(small_side(right.withColumn(member, col(key))), member).drop(member)
