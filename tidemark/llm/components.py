"""Connected components by alternating large-star and small-star rounds.

After Kiveris et al., "Connected Components in MapReduce and Beyond" (2014).
The edges of a round are written to the shared folder, so a lost executor
costs a retry and plans don't grow with the rounds.  So are the least neighbours
of each step: joined as a table of their own, the rows of a node with very many
neighbours can be split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import materialise


def _toward_least(edges: DataFrame) -> DataFrame:
    """Per node ``u``: the least of itself and its ``v``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return materialise(least, "least-neighbours")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = both.join(_toward_least(both), "u").where(F.col("v") > F.col("u"))
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _toward_least(down)
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for the nodes of ``edges`` (its first two columns) that are not their own root.

    ``root`` is the least node that can be reached.  Rows with a null end and
    loops are left out; repeated and reversed edges don't matter; without edges
    the result is empty.  Rounds are logarithmic in practice and end when a
    round changes nothing.
    """
    a, b = edges.columns[:2]
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u") != F.col("v"))
    now = materialise(_small_star(pairs), "components")
    before, state = None, _state(now)
    while state != before:
        now = materialise(_small_star(_large_star(now)), "components")
        before, state = state, _state(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
