"""Scalar column expressions used by the checks and loads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a text column may hold in place of a null.
NULL_TOKENS = ("NULL", "None")

# The size estimate assumes this many bytes per row.
BYTES_PER_ROW = 1024
BYTES_PER_MB = 1048576


def base_name(path: Column) -> Column:
    """What follows the last slash."""
    return F.substring_index(path, "/", -1)


def blank_null_tokens(c: Column) -> Column:
    """Null and the null tokens become the empty string."""
    return F.when(c.isNull() | c.isin(*NULL_TOKENS), F.lit("")).otherwise(c)


def dated_prefix(prefix: str, day: Column, days_back: int, pattern: str) -> Column:
    """``prefix`` followed by the day ``days_back`` days before ``day``."""
    return F.concat(F.lit(prefix), F.date_format(F.date_sub(day, days_back), pattern))


def millis_id(ts: Column, sequence: Column) -> Column:
    """Epoch milliseconds (truncated) plus a sequence number."""
    return F.unix_millis(ts.cast("timestamp")) + sequence


def line_amount(price: Column, quantity: Column) -> Column:
    """Price times quantity to two decimals, without going through doubles."""
    exact = price.cast("decimal(12,2)") * quantity.cast("decimal(6,0)")
    return exact.cast("decimal(18,2)")


def json_field(doc: Column, path: str, type_name: str) -> Column:
    """A field of a JSON string; a struct column is simply ``col('a.b')``."""
    return F.get_json_object(doc, path).cast(type_name)


def days_between(first: Column, last: Column) -> Column:
    """One row per day from ``first`` to ``last``, both included."""
    return F.explode(F.sequence(first, last, F.expr("interval 1 day")))


def size_mb(rows: Column) -> Column:
    return rows * F.lit(BYTES_PER_ROW) / F.lit(float(BYTES_PER_MB))


def page_count(rows: Column, page_size: int) -> Column:
    """Ceiling division on whole numbers, so that it stays exact for any count."""
    up = rows.cast("bigint") + F.lit(page_size - 1).cast("bigint")
    return F.call_function("div", up, F.lit(page_size).cast("bigint"))


def size_mb_of(rows: int) -> float:
    return rows * BYTES_PER_ROW / BYTES_PER_MB


def page_count_of(rows: int, page_size: int) -> int:
    return -(-rows // page_size)


def qualified_name(table: str, schema: str | None = "raw") -> str:
    """A quoted name; ``None`` means the default schema, ``''`` means no schema."""
    schema = "raw" if schema is None else schema
    parts = [schema, table] if schema else [table]
    return ".".join('"' + p.replace('"', '""') + '"' for p in parts)


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"

