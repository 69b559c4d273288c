"""Pages of a table that grows, from an index of its keys that is kept.

The index holds every key once, dealt into buckets that are cut at fences and
numbered one by one.  Rows that arrive go to the buckets their keys fall into,
and only these are numbered again; the others are neither shuffled nor written.
Where a page starts follows from how many rows lie in the buckets before.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.ordering import col, key_tuple, with_position
from tidemark.functions.sizes import row_bytes, small_side
from tidemark.operators.chunking import CHUNK_ID, ROWS_PER_BUCKET, Cuts, Pages, TiedKeys, check_chunk_size, rank
from tidemark.sinks.published import PublishedTable
from tidemark.workspace import materialise

_OF, _AT, _N, _GEN, _BASE, _PLACE = "__of", "__at", "__n", "__gen", "__base", "__place"
_IDX, _TIED = "__idx", "__tied"


class PageIndex:
    """An index below ``root`` of the rows of one table by ``keys``, which must be a key without nulls.

    Rows are only ever added.  A key that is null or there already fails its
    ``append``, and nothing of that is seen; so a load that is repeated by
    mistake is refused.  Of two appends at once one is refused.  Buckets hold
    ``rows_per_bucket`` rows, and are cut when they have twice as many.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self.rows_per_bucket = rows_per_bucket
        self.fences = PublishedTable(spark, f"{self.root}/fences")

    def _keys_path(self, generation: str) -> str:
        return f"{self.root}/keys/{generation}"

    @property
    def _key_columns(self):
        return [col(k) for k in self.keys]

    def _placed(self, buckets: DataFrame) -> DataFrame:
        """The buckets with their place in the order of keys, and how many rows lie before.

        One row for ``rows_per_bucket`` rows of the table.
        """
        in_order = Window.orderBy(key_tuple(self.keys))
        earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
        return buckets.withColumns({
            _PLACE: F.row_number().over(in_order) - 1,
            _BASE: F.coalesce(F.sum(_N).over(earlier), F.lit(0).cast("bigint")),
        })

    def _kept(self, buckets: DataFrame) -> DataFrame:
        """The keys of ``buckets``, each with its place in its bucket; buckets that were numbered anew are left out."""
        generations = sorted(r[0] for r in self.fences.read().select(_GEN).distinct().collect())
        kept = self.spark.read.parquet(*[self._keys_path(g) for g in generations])
        low, high = buckets.agg(F.min(_OF), F.max(_OF)).first()
        # Ids rise with each generation, so files of other buckets are passed by.
        near = kept.where(F.col(_OF).between(F.lit(low), F.lit(high)))
        return near.join(small_side(buckets.select(*[c for c in (_OF, _BASE) if c in buckets.columns])), _OF)

    def _fall_into(self, rows: DataFrame, placed: DataFrame, n_buckets: int) -> DataFrame:
        """``rows`` with the bucket each key falls into: the last one whose first key is not above it."""
        bounds = materialise(placed.where(F.col(_PLACE) > 0).select(*self._key_columns), "fences")
        found = with_position(rows, self.keys, bounds, n_buckets - 1, _PLACE)
        return found.join(small_side(placed.select(_PLACE, _OF)), _PLACE).select(*self._key_columns, _OF)

    def append(self, df: DataFrame) -> int:
        """Take the keys of ``df`` into the index; how many.

        ``df`` is read once, and only its keys.  What is shuffled are these keys
        and those kept in the buckets they fall into.
        """
        live = self.fences.live_version()
        arriving = df.select(*self._key_columns)
        if live is None:
            added = materialise(arriving.withColumn(_OF, F.lit(-1).cast("bigint")), "arriving")
            before, next_id, rows = None, 0, added
        else:
            before = materialise(self._placed(self.fences.staged(live)), "placed")
            n_buckets, last_id = before.agg(F.count(F.lit(1)), F.max(_OF)).first()
            next_id = last_id + 1
            added = materialise(self._fall_into(arriving, before, n_buckets), "arriving")
        n_added = added.count()
        if n_added == 0:
            return 0
        null = F.lit(False)
        for k in self.keys:
            null = null | col(k).isNull()
        if not added.where(null).isEmpty():
            raise ValueError(f"a key of {self.keys} is null")
        if before is not None:
            touched = materialise(added.select(_OF).distinct(), "touched")
            rows = materialise(self._kept(touched).select(*self._key_columns, _OF).unionByName(added), "touched-keys")
        generation = uuid.uuid4().hex
        self._number(rows, before, next_id, generation)
        written = self.spark.read.parquet(self._keys_path(generation))
        if not written.where(_TIED).isEmpty():
            raise TiedKeys(f"a key of {self.keys} is there more than once")
        first = F.min(F.when(F.col(_AT) == 0, key_tuple(self.keys)))
        made = written.groupBy(_OF).agg(first.alias("first"), F.count(F.lit(1)).alias(_N))
        named = [F.col("first").getField(f"k{i}").alias(k) for i, k in enumerate(self.keys)]
        fences = made.select(*named, _OF, _N, F.lit(generation).alias(_GEN))
        if before is not None:
            unchanged = before.join(small_side(touched), _OF, "left_anti")
            fences = unchanged.select(*[col(c) for c in fences.columns]).unionByName(fences)
        version, n = self.fences.stage(fences)
        self.fences.flip(version, n, replaces=live or "")
        return n_added

    def _number(self, rows: DataFrame, before: DataFrame | None, next_id: int, generation: str) -> None:
        """Write ``rows`` with new buckets, and their places in them."""
        sizes = rows.groupBy(_OF).agg(F.count(F.lit(1)).alias(_N))
        sized = sizes.withColumn(_PLACE, F.lit(0)) if before is None else sizes.join(before.select(_OF, _PLACE), _OF)
        per = F.lit(self.rows_per_bucket)
        parts = F.when(F.col(_N) < 2 * per, F.lit(1).cast("bigint")).otherwise(F.call_function("div", F.col(_N), per))
        earlier = Window.orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, -1)
        none = F.lit(0).cast("bigint")
        bases = materialise(sized.withColumn("__parts", parts).select(
            _OF, "__parts", F.coalesce(F.sum(_N).over(earlier), none).alias(_BASE),
            (F.coalesce(F.sum("__parts").over(earlier), none) + next_id).alias("__id"),
        ), "sizes")
        # Buckets are ranges of keys: the place among all these rows tells that in the bucket.
        ranked = rank(rows, self.keys, rows.count(), self.rows_per_bucket)
        local = ranked.join(small_side(bases.withColumnRenamed(_BASE, "__before")), _OF).withColumn(_AT, F.col(_IDX) - F.col("__before"))
        part = F.least(F.call_function("div", F.col(_AT), per), F.col("__parts") - 1)
        numbered = local.withColumn("__part", part).select(
            *self._key_columns, (F.col("__id") + F.col("__part")).alias(_OF),
            (F.col(_AT) - F.col("__part") * per).alias(_AT), F.coalesce(_TIED, F.lit(False)).alias(_TIED),
        )
        numbered.write.parquet(self._keys_path(generation))

    def pages(self, rows: DataFrame, chunk_size: int) -> Pages:
        """The pages of ``rows``, which are those that were appended; the kept keys are scanned, not shuffled."""
        cuts = Cuts(step=check_chunk_size(chunk_size))
        based = materialise(self._placed(self.fences.read()), "placed")
        n_rows = based.agg(F.sum(_N)).first()[0]
        found = self._kept(based).withColumn(_IDX, F.col(_BASE) + F.col(_AT)).where(cuts.at(F.col(_IDX)))
        starts = materialise(found.select(*self._key_columns, _IDX), "starts")
        size = starts.agg(F.sum(row_bytes(starts))).first()[0] or 0
        return Pages(rows, tuple(self.keys), starts, size, n_rows, chunk_size)

    def page_rows(self, rows: DataFrame, chunk_size: int) -> DataFrame:
        """``rows`` with ``_chunk_id``, as ``chunking.page_rows`` numbers them.

        With more pages than can be looked up, rows and kept keys are joined.
        Before the first append there are no rows to page.
        """
        if self.fences.live_version() is None:
            return rows.withColumn(CHUNK_ID, F.lit(0)).where(F.lit(False))
        pages = self.pages(rows, chunk_size)
        if pages.can_be_looked_up():
            return pages.tagged()
        kept = self._kept(materialise(self._placed(self.fences.read()), "placed"))
        page = F.call_function("div", F.col(_BASE) + F.col(_AT), F.lit(chunk_size)).cast("int")
        return rows.join(kept.select(*self._key_columns, page.alias(CHUNK_ID)), self.keys)

    def compact(self) -> None:
        """Write the live keys into one generation, without numbering them again."""
        live = self.fences.live_version()
        buckets = self.fences.staged(live)
        generation = uuid.uuid4().hex
        self._kept(buckets).write.parquet(self._keys_path(generation))
        version, n = self.fences.stage(buckets.withColumn(_GEN, F.lit(generation)))
        self.fences.flip(version, n, replaces=live)
