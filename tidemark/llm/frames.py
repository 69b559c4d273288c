"""What the operators share: picking input columns, and offsets from part totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.ordering import col
from tidemark.functions.sizes import small_side
from tidemark.workspace import materialise


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` and ``text`` only, so that no other column can clash; null texts are empty."""
    return df.select(
        col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def unused_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores before it until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def part_bases(table: DataFrame, part: str, size: str) -> DataFrame:
    """``part`` and ``base``: the total ``size`` of all parts before it.

    The second of two prefix sums.  The table has one row per part, that is per
    task that wrote, whatever the number of rows.
    """
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = table.groupBy(part).agg(F.sum(size).alias("total"))
    return materialise(totals.select(part, F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")), "part-bases")


def with_base(table: DataFrame, part: str, size: str) -> DataFrame:
    """``table`` with the ``base`` of each row's part."""
    return table.join(small_side(part_bases(table, part, size)), part)


def hot_chunks(n: Column, size: int) -> Column:
    """Into how many chunks of about ``size`` a group of ``n`` is split."""
    return F.ceil(n / F.lit(size)).cast("int")
