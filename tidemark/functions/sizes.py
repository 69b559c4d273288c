"""Checks that a table is small before anything relies on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.ordering import col

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# Fixed width assumed for every value that has no length of its own.
FIXED_WIDTH = 16


def row_bytes(df: DataFrame) -> Column:
    """An estimate of the row's size from the lengths of its values."""
    widths = []
    for field in df.schema.fields:
        c = col(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            widths.append(F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(FIXED_WIDTH))
        elif isinstance(field.dataType, T.AtomicType):
            widths.append(F.lit(FIXED_WIDTH))
        else:
            widths.append(F.coalesce(F.octet_length(c.cast("string")), F.lit(0)) + F.lit(FIXED_WIDTH))
    total = F.lit(0)
    for w in widths:
        total = total + w
    return total.cast("bigint")


def fits(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and about ``max_bytes`` bytes.

    Each task adds up its own part, so measuring a large table is harmless.
    """
    measured = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_bytes(df)), F.lit(0).cast("bigint")).alias("bytes"),
    ).first()
    return measured["rows"] <= max_rows and measured["bytes"] <= max_bytes


def small_side(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """One side of a join: broadcast if it was measured to be small, else merged.

    Without the second hint Spark might broadcast the other side on an estimate
    that misses how rows multiply when arrays are unrolled.
    """
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df.hint("merge")
