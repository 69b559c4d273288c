"""SQL text for reading a table by key ranges.

Ranges only fit together if the database orders keys the way the cuts are
sorted, so text is compared by code, never by the column's own collation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from decimal import Decimal

from tidemark.functions.scalars import qualified_name, sql_text

# The collation under which each database compares text by code.
CODE_COLLATION = {
    "sqlserver": "COLLATE Latin1_General_100_BIN2",
    "postgres": 'COLLATE "C"',
}

# Types that Spark reads as text but that take no collation.
UUID_TYPES = {"uuid", "uniqueidentifier"}

# How text sorts under that collation.
_CODE_ENCODING = {"sqlserver": "utf-16-be", "postgres": "utf-8"}


def quote(name: str) -> str:
    """A standard quoted identifier, understood by every supported database."""
    return '"' + name.replace('"', '""') + '"'


def literal(value, kind: str) -> str:
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal, date, str)):
        raise TypeError(f"keys of type {type(value).__name__} cannot be cut into ranges")
    if isinstance(value, str):
        return ("N" if kind == "sqlserver" else "") + sql_text(value)
    return sql_text(str(value)) if isinstance(value, date) else str(value)


def _side(name: str, value, kind: str, db_type: str) -> str:
    """The column in the order in which Spark sorts it.

    PostgreSQL sorts UUIDs as it writes them; SQL Server sorts its own by their
    last bytes, so there their text is compared.
    """
    if db_type.lower() in UUID_TYPES:
        if kind == "postgres":
            return quote(name)
        return f"CONVERT(CHAR(36), {quote(name)}) {CODE_COLLATION[kind]}"
    return f"{quote(name)} {CODE_COLLATION[kind]}" if isinstance(value, str) else quote(name)


def compare(
    keys: Sequence[str], values: Sequence, kind: str, strict: str, last: str, types: Mapping[str, str] = {}
) -> str:
    """The key tuple against ``values``: ``strict`` on leading columns, ``last`` on the last."""
    side, at = _side(keys[0], values[0], kind, types.get(keys[0], "")), literal(values[0], kind)
    if len(keys) == 1:
        return f"{side} {last} {at}"
    rest = compare(keys[1:], values[1:], kind, strict, last, types)
    return f"({side} {strict} {at} OR ({side} = {at} AND {rest}))"


def not_before(keys: Sequence[str], values: Sequence, kind: str, types: Mapping[str, str] = {}) -> str:
    return compare(keys, values, kind, ">", ">=", types)


def before(keys: Sequence[str], values: Sequence, kind: str, types: Mapping[str, str] = {}) -> str:
    return compare(keys, values, kind, "<", "<", types)


def _by_code(cut: Sequence, kind: str) -> tuple:
    return tuple(v.encode(_CODE_ENCODING[kind]) if isinstance(v, str) else v for v in cut)


def range_predicates(
    keys: Sequence[str], cuts: Sequence[Sequence], kind: str, types: Mapping[str, str] = {}
) -> list[str]:
    """One predicate per range between neighbouring cuts; together they miss nothing.

    ``types`` has the database's own types of key columns, as far as they matter.
    """
    if not cuts:
        return ["1 = 1"]
    cuts = sorted(cuts, key=lambda c: _by_code(c, kind))
    ranges = [before(keys, cuts[0], kind, types)]
    for low, high in zip(cuts, cuts[1:]):
        ranges.append(f"{not_before(keys, low, kind, types)} AND {before(keys, high, kind, types)}")
    ranges.append(not_before(keys, cuts[-1], kind, types))
    return ranges


def hash_predicates(column: str, n: int, kind: str) -> list[str]:
    """``n`` predicates that deal the rows out by a hash of one column, for columns without even strides."""
    name = quote(column)
    if kind == "postgres":
        place = f"MOD(ABS(HASHTEXT(CAST({name} AS TEXT))::BIGINT), {n})"
    else:
        place = f"ABS(CAST(CHECKSUM({name}) AS BIGINT)) % {n}"
    return [f"COALESCE({place}, 0) = {i}" for i in range(n)]  # a null has no hash in one of them


def count_query(table: str, schema: str | None) -> str:
    return f"SELECT COUNT(*) AS row_count FROM {qualified_name(table, schema)}"


def type_query(table: str, schema: str | None) -> str:
    """Every column's name and the database's own name of its type."""
    schema = "raw" if schema is None else schema
    in_schema = f" AND table_schema = {sql_text(schema)}" if schema else ""
    return (
        "SELECT column_name, data_type FROM information_schema.columns"
        f" WHERE table_name = {sql_text(table)}{in_schema}"
    )


def key_query(table: str, schema: str | None, kind: str = "sqlserver") -> str:
    """Primary key columns with their place in the key.

    PostgreSQL shows constraints in the standard views only to those who may
    change the table, so its own catalog is asked, which everyone may read.
    """
    schema = "raw" if schema is None else schema
    if kind == "postgres":
        in_schema = f" AND n.nspname = {sql_text(schema)}" if schema else " AND pg_table_is_visible(c.oid)"
        return (
            "SELECT a.attname AS column_name, k.place AS ordinal_position"
            " FROM pg_index i JOIN pg_class c ON c.oid = i.indrelid JOIN pg_namespace n ON n.oid = c.relnamespace"
            " CROSS JOIN LATERAL unnest(i.indkey::int2[]) WITH ORDINALITY AS k(attnum, place)"
            " JOIN pg_attribute a ON a.attrelid = c.oid AND a.attnum = k.attnum"
            f" WHERE i.indisprimary AND c.relname = {sql_text(table)}{in_schema}"
        )
    in_schema = f" AND tc.table_schema = {sql_text(schema)}" if schema else ""
    return (
        "SELECT kcu.column_name AS column_name, kcu.ordinal_position AS ordinal_position"
        " FROM information_schema.table_constraints tc"
        " JOIN information_schema.key_column_usage kcu"
        " ON tc.constraint_name = kcu.constraint_name"
        " AND tc.table_schema = kcu.table_schema AND tc.table_name = kcu.table_name"
        f" WHERE tc.constraint_type = 'PRIMARY KEY' AND tc.table_name = {sql_text(table)}{in_schema}"
    )


def ends_query(table: str, schema: str | None, column: str) -> str:
    c = quote(column)
    return f"SELECT MIN({c}) AS lo, MAX({c}) AS hi FROM {qualified_name(table, schema)}"
