"""Published tables whose versions carry a tree of digests, so that a diff reads only what differs.

Rows are dealt into buckets by their key and written with a digest each.  A
bucket's digest covers its rows, a group's its buckets, the root's its groups.
Two versions are compared from the root down: equal nodes are passed by, and of
the buckets that differ only keys and digests are read.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.ordering import col
from tidemark.operators import history
from tidemark.sinks.published import PublishedTable
from tidemark.workspace import path_exists, remove

BUCKET, DIGEST = "__bucket", "__digest"
# The numbers of differing buckets go through the driver into the scan's filter.
MAX_BUCKETS = 1 << 16
_PIECE = 4


def _bag_digest(digest: Column) -> Column:
    """A digest of the group's rows, whatever their order: eight sums of a part of each row's digest.

    Sums keep count of copies and are formed per task before the shuffle.
    """
    parts = [F.conv(F.hex(F.substring(digest, 1 + _PIECE * i, _PIECE)), 16, 10).cast("decimal(20,0)") for i in range(8)]
    return F.sha2(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *[F.sum(p).cast("string") for p in parts]), 256)


def _node_digest() -> Column:
    """A digest of the group's nodes in their order."""
    in_order = F.sort_array(F.collect_list(F.struct("node", "digest")))
    spelled = F.transform(in_order, lambda n: F.concat_ws(":", n["node"].cast("string"), n["digest"]))
    return F.sha2(F.concat_ws(",", spelled), 256)


class DigestedTable(PublishedTable):
    """A published table of rows known by ``keys``, which may be compared version by version.

    ``buckets`` (at most 65,536) is best chosen so that one holds about a
    gigabyte; ``fanout`` buckets form a group, so no task gathers more than
    that many digests, or ``buckets / fanout`` of them at the root.  Columns
    must be of atomic types.  Large buckets are written by several tasks.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 256, fanout: int = 256):
        if not 1 <= buckets <= MAX_BUCKETS or fanout < 2:
            raise ValueError(f"1 to {MAX_BUCKETS} buckets and a fanout of two or more are needed")
        super().__init__(spark, root)
        self.keys, self.n_buckets, self.fanout = list(keys), buckets, fanout

    def _tree_path(self, version: str, level: str) -> str:
        return f"{self.root}/digests/{version}/{level}"

    def stage(self, df: DataFrame, partition_by: Sequence[str] = ()) -> tuple[str, int]:
        """As ``PublishedTable.stage``, with the digests of what was written."""
        if partition_by:
            raise ValueError("a table with digests is laid out by its buckets")
        bucket = F.pmod(F.xxhash64(*[col(k) for k in self.keys]), F.lit(self.n_buckets)).cast("int")
        dealt = df.withColumns({DIGEST: history.row_digest(df, sorted(df.columns)), BUCKET: bucket})
        version, n_rows = super().stage(dealt.hint("rebalance", F.col(BUCKET)), [BUCKET])
        # The tree must compare with that of another version only if both were built alike.
        fields = sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields)
        layout = json.dumps([fields, self.keys, self.n_buckets, self.fanout])
        written = self._whole(version).groupBy(F.col(BUCKET).alias("node")).agg(_bag_digest(F.col(DIGEST)).alias("digest"))
        parent = F.floor(F.col("node") / self.fanout).cast("int")
        written.withColumn("parent", parent).write.parquet(self._tree_path(version, "buckets"))
        groups = self._level(version, "buckets").groupBy(F.col("parent").alias("__p")).agg(_node_digest().alias("digest"))
        groups.select(F.col("__p").alias("node"), "digest").write.parquet(self._tree_path(version, "groups"))
        root = self._level(version, "groups").agg(_node_digest().alias("digest")).withColumn("layout", F.lit(layout))
        root.write.parquet(self._tree_path(version, "root"))
        return version, n_rows

    def _level(self, version: str, level: str) -> DataFrame:
        names = {"buckets": "node int, digest string, parent int", "groups": "node int, digest string", "root": "digest string, layout string"}
        return self.spark.read.schema(names[level]).parquet(self._tree_path(version, level))

    def _whole(self, version: str) -> DataFrame:
        return super().staged(version)

    def staged(self, version: str) -> DataFrame:
        return self._whole(version).drop(BUCKET, DIGEST)

    def forget(self, version: str) -> None:
        super().forget(version)
        remove(self.spark, f"{self.root}/digests/{version}")

    def _differing(self, old: str, new: str, level: str, parents: Sequence[int] | None = None) -> list[int]:
        """The nodes of a level that are not the same in both versions, below ``parents``."""
        sides = []
        for version, name in ((old, "a"), (new, "b")):
            nodes = self._level(version, level)
            if parents is not None:
                nodes = nodes.where(F.col("parent").isin(list(parents)))
            sides.append(nodes.select("node", F.col("digest").alias(name)))
        differs = ~F.col("a").eqNullSafe(F.col("b"))
        both = sides[0].join(sides[1], "node", "full_outer").where(differs)
        return sorted(r["node"] for r in both.select("node").collect())

    def changed_buckets(self, old: str, new: str) -> list[int] | None:
        """The buckets whose rows differ between two versions; None if these were not built alike."""
        for version in (old, new):
            if not path_exists(self.spark, self._tree_path(version, "root")):
                raise LookupError(f"{version} has no digests")
        before, after = (self._level(v, "root").first() for v in (old, new))
        if before["layout"] != after["layout"]:
            return None
        if before["digest"] == after["digest"]:
            return []
        return self._differing(old, new, "buckets", self._differing(old, new, "groups"))

    def diff(self, old: str, new: str, check_keys: bool = True, new_repeats: bool = False) -> DataFrame:
        """The keys whose rows differ, with ``op``: insert, update or delete from ``old`` to ``new``.

        Of the buckets that differ, keys and digests are read and folded in one
        shuffle.  A null key, or one that repeats, fails the job that meets it in
        such a bucket, unless ``check_keys`` is off; with ``new_repeats`` those of
        ``new`` may repeat, and each row is compared.  Versions that were not
        built alike (other columns, keys or buckets) are compared whole.
        """
        checks = {"check_keys": check_keys, "new_repeats": new_repeats}
        buckets = self.changed_buckets(old, new)
        if buckets is None:
            whole = history.snapshot_diff(self.staged(old), self.staged(new), self.keys, by_digest=True, **checks)
            return whole.where(F.col("op") != "same")
        read = [col(k) for k in self.keys] + [F.col(DIGEST)]
        before, after = (self._whole(v).where(F.col(BUCKET).isin(buckets)).select(*read) for v in (old, new))
        return history.snapshot_diff(before, after, self.keys, **checks).where(F.col("op") != "same")
