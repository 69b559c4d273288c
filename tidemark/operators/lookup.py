"""Projections, filters and small look-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.ordering import col
from tidemark.functions.sizes import small_side
from tidemark.operators.chunking import rows_between
from tidemark.workspace import materialise

SAMPLE_ROWS = 5

# Draws are whole numbers below two to this power.
DRAW_BITS = 60
# Standard deviations by which more rows than wanted are looked at.
DRAW_SLACK = 6


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[col(c) for c in columns])


def equal_to(df: DataFrame, **values) -> DataFrame:
    """Rows where every named column equals its value."""
    for name, value in values.items():
        df = df.where(col(name) == F.lit(value))
    return df


def sample_rows(df: DataFrame, keys: Sequence[str], n: int = SAMPLE_ROWS) -> DataFrame:
    """The first rows in key order."""
    return df.orderBy(*[col(k) for k in keys]).limit(n)


def latest_record(df: DataFrame, order_by: str, tie_breaker: str) -> DataFrame:
    """The record with the greatest ``order_by``; ties go to the greatest tie-breaker."""
    return df.orderBy(F.desc_nulls_last(order_by), F.desc_nulls_last(tie_breaker)).limit(1)


def active_jobs(
    jobs: DataFrame, active: Column, job_name: Column, wanted: str | None, order_by: str
) -> DataFrame:
    """Active jobs named ``wanted`` in run order; ``None`` selects jobs without a name."""
    return jobs.where(active & job_name.eqNullSafe(F.lit(wanted))).orderBy(col(order_by))


def hash_sample(df: DataFrame, percent: int, bucket: Column) -> DataFrame:
    """About ``percent`` of the rows, always the same ones for the same ``bucket``."""
    return df.where(bucket < F.lit(percent))


def fixed_size_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows (all of them if there are fewer), chosen by hash of the key."""
    drawn = "__draw"
    hashed = df.withColumn(drawn, F.xxhash64(col(key), F.lit(seed)))
    return rows_between(hashed, [drawn, key], 0, n).drop(drawn)


def sample_per_group(
    df: DataFrame,
    groups: Sequence[str],
    keys: Sequence[str],
    n: int,
    draw: Column | None = None,
    seed: int = 0,
) -> DataFrame:
    """Exactly ``n`` rows of each group (all of a smaller one): those with the least ``draw``, then the least key.

    ``draw`` is a whole number below ``2 ** DRAW_BITS`` worked out from the row,
    by default a hash of the keys and ``seed``; null groups and keys are like any
    other.  The groups are counted, which says below which draw about ``n`` of
    their rows and some more must lie; one more scan keeps these alone.  Where
    at least ``n`` were kept they hold the sample for certain; for groups where
    fewer were, the bound is doubled.  So what is shuffled grows with the sample
    and not with a group, however many rows or tasks that has.
    """
    if n < 1:
        return df.where(F.lit(False))
    columns = df.columns
    if not groups:
        df, groups = df.withColumn("__all", F.lit(0)), ["__all"]
    value = F.shiftrightunsigned(F.xxhash64(*[col(k) for k in keys], F.lit(seed)), 64 - DRAW_BITS) if draw is None else draw
    drawn = df.withColumn("__draw", value)
    own = [f"__g{i}" for i in range(len(groups))]
    counts = df.groupBy(*[col(g).alias(name) for g, name in zip(groups, own)]).agg(F.count(F.lit(1)).alias("__rows"))
    share = F.least(F.lit(1.0), F.lit(n + DRAW_SLACK * n**0.5 + DRAW_SLACK**2) / F.col("__rows"))
    waiting = materialise(counts.withColumn("__below", (share * F.lit(float(1 << DRAW_BITS))).cast("bigint")), "draws")
    same = F.lit(True)
    for g, name in zip(groups, own):
        same = same & col(g).eqNullSafe(F.col(name))
    found = None
    while not waiting.isEmpty():
        below = drawn.join(small_side(waiting), same).where(F.col("__draw") < F.col("__below"))
        kept = materialise(below, "drawn")
        met = kept.groupBy(*own).agg(F.count(F.lit(1)).alias("__met"))
        enough = F.col("__met") >= F.least(F.lit(n), F.col("__rows"))
        alike = [waiting[name].eqNullSafe(met[name]) for name in own]
        both = waiting.join(met, alike, "left").withColumn("__enough", F.coalesce(enough, F.lit(False)))
        checked = materialise(both.select(*[waiting[name] for name in own], "__rows", "__below", "__enough"), "draws")
        whole = F.lit(True)
        for name in own:
            whole = whole & kept[name].eqNullSafe(checked[name])
        done = kept.join(small_side(checked.where("__enough").select(*own)), whole, "left_semi")
        found = done if found is None else found.unionByName(done)
        waiting = checked.where("NOT __enough").withColumn("__below", F.col("__below") * 2).drop("__enough")
    if found is None:
        return df.where(F.lit(False)).select(*[col(c) for c in columns])
    first = Window.partitionBy(*own).orderBy("__draw", *[col(k) for k in keys])
    placed = found.withColumn("__place", F.row_number().over(first)).where(F.col("__place") <= n)
    return placed.select(*[col(c) for c in columns])
