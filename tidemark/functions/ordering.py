"""Key tuples, and exact positions in a sorted list of bounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEY, _BOUNDS = "__key", "__bounds"


def quoted(name: str) -> str:
    """A column name as one identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def key_tuple(keys: Sequence[str]) -> Column:
    """The key columns as one comparable value (nulls first, as in ``orderBy``)."""
    return F.struct(*[col(k).alias(f"k{i}") for i, k in enumerate(keys)])


def with_position(
    df: DataFrame, keys: Sequence[str], bounds: DataFrame, n_bounds: int, name: str
) -> DataFrame:
    """Add ``name`` = how many rows of ``bounds`` are at or below the row's key.

    ``bounds`` holds the key columns, no tuple twice and at most ``n_bounds``
    rows; the caller has checked their size.  Rows stay where they are: the
    bounds travel to the tasks once, and each row searches them by halving.
    The key and the bounds are put next to each other, and each is read once:
    so Spark merges the search with this projection, whatever the key columns
    are computed from, and no row carries the bounds.
    """
    if n_bounds == 0:
        return df.withColumn(name, F.lit(0))
    ordered = bounds.agg(F.sort_array(F.collect_list(key_tuple(keys)))).scalar()
    # Of the bounds' own type, nulls and all: else Spark would convert the key at each comparison.
    kind = bounds.select(key_tuple(keys).alias(_KEY)).schema[_KEY].dataType
    asked = df.withColumns({_KEY: key_tuple(keys).cast(kind), _BOUNDS: ordered})
    return asked.withColumn(name, _at_or_below(F.col(_KEY), F.col(_BOUNDS), n_bounds)).drop(_KEY, _BOUNDS)


def _at_or_below(key: Column, bounds: Column, n_bounds: int) -> Column:
    """The number of bounds at or below the key, found in about log2(n) comparisons.

    The key is bound to a variable: named in the steps themselves, whatever it
    is computed from (a hash of a file's path) would be computed at each step.
    """
    steps = [2**i for i in range(n_bounds.bit_length())][::-1]

    def found(k: Column) -> Column:
        return F.aggregate(
            F.lit(steps),
            F.lit(0),
            lambda pos, step: F.when(F.get(bounds, pos + step - 1) <= k, pos + step).otherwise(pos),
        )

    return F.coalesce(F.get(F.transform(F.array(key), found), F.lit(0)), F.lit(0))
