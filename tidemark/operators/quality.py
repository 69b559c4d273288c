"""Checks on landed data: null profile, and expected against actual items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ordering import col
from tidemark.functions.scalars import base_name, blank_null_tokens
from tidemark.functions.sizes import fits, small_side
from tidemark.operators.chunking import CHUNK_ID, page_rows
from tidemark.workspace import materialise

# Up to this many expected names are tested one by one on every file name; the result is the same.
# Characters of the parts by which names and patterns of a long list are joined.
GRAM = 4
MAX_TESTED_NAMES = 256


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How many nulls each column holds, all columns in one pass."""
    names = list(columns) if columns is not None else df.columns
    counted = df.agg(*[F.count_if(col(c).isNull()).alias(c) for c in names])
    return counted.unpivot([], [col(c) for c in names], "column_name", "null_count")


# --- codes --------------------------------------------------------------------


def code_pairs(df: DataFrame, code: str, subcode: str) -> DataFrame:
    """Distinct pairs, after the ways of writing "no sub code" became one."""
    return df.select(
        col(code).alias("code"), blank_null_tokens(col(subcode)).alias("subcode")
    ).distinct()


def reconcile_codes(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Each pair with ``status`` matched, new or missing.

    ``actual`` may hold any number of copies: both sides are folded by pair in
    a single aggregation, before and after its one shuffle.
    """
    sides = actual.select(
        "code", blank_null_tokens(F.col("subcode")).alias("subcode"), F.lit(1).alias("a"), F.lit(0).alias("e")
    ).unionByName(
        expected.select(
            "code", blank_null_tokens(F.col("subcode")).alias("subcode"), F.lit(0).alias("a"), F.lit(1).alias("e")
        )
    )
    seen = sides.groupBy("code", "subcode").agg(F.max("a").alias("a"), F.max("e").alias("e"))
    status = (
        F.when(F.col("e") == 0, "new").when(F.col("a") == 0, "missing").otherwise("matched")
    )
    return seen.select("code", "subcode", status.alias("status"))


def code_status(reconciled: DataFrame) -> DataFrame:
    """One row: how many pairs are in each state, and whether all is well."""
    return reconciled.agg(
        F.count_if(F.col("status") == "matched").alias("matched"),
        F.count_if(F.col("status") == "new").alias("new"),
        F.count_if(F.col("status") == "missing").alias("missing"),
    ).withColumn(
        "status",
        F.when((F.col("new") == 0) & (F.col("missing") == 0), "match").otherwise("mismatch"),
    )


# Copies of one row that are put out at a time.
COPIES = 1 << 16


def bag_difference(left: DataFrame, right: DataFrame, counted: bool = False) -> DataFrame:
    """``side`` and the columns of ``left``: each row as often as that side has it more than the other.

    Rows count with their copies, nulls are equal.  Both sides are folded to
    signed counts before the one shuffle, so a row costs the same however many
    copies it has; copies are put out at the end, ``COPIES`` at a time.  With
    ``counted`` there is one row with its number of copies, ``n``, instead.
    """
    columns = [col(c) for c in left.columns]
    signed = left.select(*columns, F.lit(1).alias("__n")).unionByName(right.select(*columns, F.lit(-1).alias("__n")))
    net = signed.groupBy(*columns).agg(F.sum("__n").alias("__n")).where(F.col("__n") != 0)
    side = F.when(F.col("__n") > 0, F.lit("left")).otherwise(F.lit("right")).alias("side")
    rows = net.select(side, *columns, F.abs("__n").alias("__n"))
    if counted:
        return rows.withColumnRenamed("__n", "n")
    blocks = rows.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(__n - 1) div {COPIES}"))))
    here = F.least(F.lit(COPIES).cast("bigint"), F.col("__n") - F.col("__block") * COPIES)
    return blocks.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), here))).select("side", *columns)


# --- names --------------------------------------------------------------------


def reconcile_names(
    files: DataFrame,
    path: str,
    expected: DataFrame,
    keep: Sequence[str] = (),
    max_tested: int = MAX_TESTED_NAMES,
) -> DataFrame:
    """Each file with the first expected name (by ``ord``) its base name contains.

    ``expected`` has ``ord`` and ``pattern``; a null in either is refused, and
    equal ``ord`` is settled by ``pattern``.  A file that contains none of them
    is new: its ``pattern`` is null.  A short list is tested on every name in
    place; a longer one is matched by joining on the rarest part of each pattern.
    """
    if not expected.where(F.col("ord").isNull() | F.col("pattern").isNull()).isEmpty():
        raise ValueError("expected names need an ord and a pattern each")
    named = files.select(*[col(k) for k in keep], base_name(col(path)).alias("base_name"))
    if fits(expected, max_tested):
        return _test_each(named, expected)
    return _join_rarest(named, expected)


def _test_each(named: DataFrame, expected: DataFrame) -> DataFrame:
    in_order = sorted((r["ord"], r["pattern"]) for r in expected.collect())
    found: Column = F.when(F.lit(False), F.lit(""))
    for _, pattern in in_order:
        found = found.when(F.contains(F.col("base_name"), F.lit(pattern)), F.lit(pattern))
    return named.withColumn("pattern", found)


def _grams(df: DataFrame, text: str) -> DataFrame:
    """``df`` once for each distinct part of ``GRAM`` characters of ``text``."""
    places = F.sequence(F.lit(1), F.length(text) - GRAM + 1)
    parts = F.array_distinct(F.transform(places, lambda at: F.substring(F.col(text), at, F.lit(GRAM))))
    return df.where(F.length(text) >= GRAM).withColumn("__gram", F.explode(parts))


def rarest_grams(names: DataFrame, patterns: DataFrame) -> DataFrame:
    """``pattern, __gram, __names``: the part of each pattern that the fewest ``base_name`` have, and how many.

    Patterns with a part that no name has are left out: nothing contains them.
    """
    own = _grams(patterns.select("pattern"), "pattern")
    asked = own.groupBy("__gram").agg(F.count(F.lit(1)).alias("__patterns"))
    # each task folds its names by gram before they are shuffled
    met = _grams(names, "base_name").join(small_side(asked), "__gram")
    counts = met.groupBy("__gram", "__patterns").agg(F.count(F.lit(1)).alias("__names"))
    known = own.join(counts, "__gram", "left")
    first = F.struct(F.coalesce("__names", F.lit(0).cast("bigint")).alias("n"), F.col("__patterns").alias("p"), F.col("__gram").alias("gram"))
    least = known.groupBy("pattern").agg(F.min(first).alias("least")).where("least.n > 0")
    return least.select("pattern", F.col("least.gram").alias("__gram"), F.col("least.n").alias("__names"))


def _join_rarest(named: DataFrame, expected: DataFrame) -> DataFrame:
    """Containment as an equi-join.

    Each pattern is known by the one of its parts of ``GRAM`` characters that
    the fewest names have, whatever beginning or ending it shares with others.
    Names meet it by that part alone, and the pattern is looked for in place: so
    a key meets as many names as have its part, which is as few as the pattern
    allows.  Patterns shorter than a part are known by their beginning.
    """
    first = materialise(expected.groupBy("pattern").agg(F.min("ord").alias("ord")), "expected-names")
    distinct = materialise(named.select("base_name").distinct(), "base-names")
    long = first.where(F.length("pattern") >= GRAM)
    anchors = materialise(rarest_grams(distinct, long).join(long, "pattern"), "rarest-grams")
    met = _grams(distinct, "base_name").join(small_side(anchors), "__gram")
    hits = met.where(F.contains(F.col("base_name"), F.col("pattern"))).select("base_name", "pattern", "ord")
    hits = hits.unionByName(_short_hits(distinct, first.where(F.length("pattern") < GRAM)))
    found = hits.groupBy("base_name").agg(F.min_by("pattern", F.struct("ord", "pattern")).alias("pattern"))
    return named.join(found, "base_name", "left").select(*named.columns, "pattern")


def _short_hits(distinct: DataFrame, patterns: DataFrame) -> DataFrame:
    """``base_name, pattern, ord`` for patterns of fewer than ``GRAM`` characters: all parts of their lengths are joined."""
    sizes = F.array(*[F.lit(n) for n in range(GRAM)])
    places = distinct.withColumn("__len", F.explode(sizes)).where(F.col("__len") <= F.length("base_name"))
    last = F.when(F.col("__len") == 0, 1).otherwise(F.length("base_name") - F.col("__len") + 1)
    at = F.sequence(F.lit(1), last)
    parts = F.array_distinct(F.transform(at, lambda i: F.substring(F.col("base_name"), i, F.col("__len"))))
    return places.withColumn("pattern", F.explode(parts)).join(small_side(patterns), "pattern").select("base_name", "pattern", "ord")


def names_found(reconciled: DataFrame, expected: DataFrame) -> DataFrame:
    """Per expected name: how many files matched it, and whether it is missing."""
    counted = reconciled.where(F.col("pattern").isNotNull()).groupBy("pattern").agg(
        F.count(F.lit(1)).alias("n")
    )
    n_files = F.coalesce(F.col("n"), F.lit(0).cast("bigint"))
    return (
        expected.select("pattern")
        .distinct()
        .join(counted, "pattern", "left")
        .select("pattern", n_files.alias("n_files"), (n_files == 0).alias("missing"))
    )


def name_status(reconciled: DataFrame, expected: DataFrame) -> DataFrame:
    """One row: expected and actual counts, new and missing, and the verdict.

    The counts must agree and no expected name may be missing.
    """
    counted = reconciled.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    wanted = expected.select("pattern").distinct().withColumn("wanted", F.lit(True))
    none = F.lit(0).cast("bigint")
    totals = wanted.join(counted, "pattern", "full_outer").agg(
        F.count("wanted").alias("expected_count"),
        F.coalesce(F.sum("n"), none).alias("latest_count"),
        F.coalesce(F.sum(F.when(F.col("wanted").isNull(), F.col("n"))), none).alias("new_files"),
        F.count_if(F.col("n").isNull()).alias("missing_files"),
    )
    bad = (F.col("expected_count") != F.col("latest_count")) | (F.col("missing_files") > 0)
    return totals.withColumn("status", F.when(bad, "mismatch").otherwise("match"))


# --- text ---------------------------------------------------------------------


def mismatch_text(
    items: DataFrame, columns: Sequence[str], items_per_line: int, separator: str = ", "
) -> DataFrame:
    """``line, summary``: the items as text in column order, ``items_per_line`` to a line.

    Lines are numbered from 0 and all but the last are full, so a set of up to
    ``items_per_line`` items is one line.  No task holds more than a line.
    """
    kept = materialise(items.select(*[col(c) for c in columns]), "items")
    in_order = F.sort_array(F.collect_list(F.struct(*[col(c) for c in columns])))
    texts = F.transform(in_order, lambda s: F.concat_ws(" ", *[s[c].cast("string") for c in columns]))
    lines = page_rows(kept, columns, items_per_line).groupBy(CHUNK_ID)
    return lines.agg(F.concat_ws(separator, texts).alias("summary")).select(
        F.col(CHUNK_ID).alias("line"), "summary"
    )
