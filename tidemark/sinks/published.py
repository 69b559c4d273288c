"""Staged publishing: readers see the whole old version or the whole new one.

A version is written to a folder of its own, checked, and only then entered in
a small log of publications, numbered in the order in which they were made.
Readers follow the last entry, so a load that fails or is still running is never
seen, and an older version can be made the live one again.  Versions stay in
place for readers that have already started, until ``leases.clean`` removes them.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sinks.leases import held
from tidemark.workspace import create_text, file_names, read_text, remove

_LOG_SCHEMA = "number bigint, version string, n_rows bigint, columns string, note string, published_at timestamp"
_BASE = "_base"


class PublishRefused(RuntimeError):
    """A staged version did not pass its check, or what it was to replace is no longer live."""


class PublishedTable:
    """A table whose versions live below ``root``.

    With ``buckets`` each version is also entered in the session's catalog as a
    table bucketed by ``bucket_by``, so that a join or aggregation on those
    columns need not shuffle it.  Where the catalog does not know a version, its
    files are read all the same.
    """

    def __init__(
        self, spark: SparkSession, root: str, bucket_by: Sequence[str] = (), buckets: int = 0
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.bucket_by = list(bucket_by)
        self.buckets = buckets if bucket_by else 0
        self._staged_columns: dict[str, StructType] = {}

    def version_path(self, version: str) -> str:
        return f"{self.root}/versions/{version}"

    @property
    def _log_path(self) -> str:
        return f"{self.root}/publications"

    def catalog_name(self, version: str) -> str:
        place = hashlib.sha256(self.root.encode()).hexdigest()[:16]
        return f"tidemark_{place}_{version.replace('-', '_')}".lower()

    def stage(self, df: DataFrame, partition_by: Sequence[str] = ()) -> tuple[str, int]:
        """Write a version nobody reads yet; its name and the rows written.

        The version remembers which one was live when it was begun.
        """
        base = self.live_version() or ""
        version = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        written = Observation()
        counted = df.observe(written, F.count(F.lit(1)).alias("n"))
        writer = counted.write.format("parquet").partitionBy(*partition_by)
        writer = writer.option("path", self.version_path(version))
        if self.buckets:
            bucketed = writer.bucketBy(self.buckets, *self.bucket_by).sortBy(*self.bucket_by)
            bucketed.saveAsTable(self.catalog_name(version))
        else:
            writer.save()
        create_text(self.spark, f"{self.version_path(version)}/{_BASE}", base)
        self._staged_columns[version] = df.schema
        return version, written.get["n"]

    def columns_of(self, version: str) -> StructType:
        """The version's columns, known also where it has no rows and so no files."""
        if version not in self._staged_columns:
            logged = self.log().where(F.col("version") == version).select("columns").first()
            if logged is None:
                return self.spark.read.parquet(self.version_path(version)).schema
            self._staged_columns[version] = StructType.fromJson(json.loads(logged[0]))
        return self._staged_columns[version]

    def staged(self, version: str) -> DataFrame:
        if self.buckets and self.spark.catalog.tableExists(self.catalog_name(version)):
            return self.spark.table(self.catalog_name(version))
        reader = self.spark.read.schema(self.columns_of(version))
        return reader.parquet(self.version_path(version))

    def _base_of(self, version: str) -> str:
        return read_text(self.spark, f"{self.version_path(version)}/{_BASE}") or ""

    def flip(
        self, version: str, expected_rows: int | None = None, replaces: str | None = None, note: str = ""
    ) -> None:
        """Make a staged version the live one, if it holds what it should.

        It replaces the version that was live when it was staged, or the one
        that ``replaces`` names; if another is live by now, that is refused, as
        what the other one brought would be lost.  Of two flips at once one is
        refused, since both need the same number.
        """
        with held(self, version):
            landed = self.staged(version).agg(F.count(F.lit(1))).first()[0]
            if expected_rows is not None and landed != expected_rows:
                raise PublishRefused(f"{version}: expected {expected_rows} rows, found {landed}")
            number = self._last_number() + 1
            live, base = self.live_version(), self._base_of(version) if replaces is None else replaces
            if (live or "") != base:
                raise PublishRefused(f"{version} was to replace {base or 'nothing'}, but {live or 'nothing'} is live")
            entry = {
                "number": number,
                "version": version,
                "n_rows": landed,
                "columns": self.columns_of(version).json(),
                "note": note,
                "published_at": datetime.now(timezone.utc).isoformat(),
            }
            if not create_text(self.spark, f"{self._log_path}/{number:012d}.json", json.dumps(entry) + "\n"):
                raise PublishRefused(f"{version}: another version was published at the same time")

    def publish(
        self,
        df: DataFrame,
        expected_rows: int | None = None,
        partition_by: Sequence[str] = (),
        note: str = "",
    ) -> str:
        version, n_rows = self.stage(df, partition_by)
        self.flip(version, n_rows if expected_rows is None else expected_rows, note=note)
        return version

    def forget(self, version: str) -> None:
        """Remove a version's rows; ``leases.clean`` does so for versions that nobody needs."""
        if self.buckets:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.catalog_name(version)}")
        remove(self.spark, self.version_path(version))

    def _last_number(self) -> int:
        """The number of the last publication, also of one that broke off while it was entered."""
        return max((int(n.removesuffix(".json")) for n in file_names(self.spark, self._log_path) if n.endswith(".json")), default=0)

    def log(self) -> DataFrame:
        """All publications; none before the first."""
        if not self._last_number():
            return self.spark.createDataFrame([], _LOG_SCHEMA)
        return self.spark.read.schema(_LOG_SCHEMA).json(self._log_path).where("version is not null")

    def published_versions(self) -> list[str]:
        """The names of all versions that were ever made live, in that order."""
        return [r["version"] for r in self.log().select("number", "version").orderBy("number").collect()]

    def live_version(self) -> str | None:
        last = self.log().orderBy(F.desc("number")).select("version").first()
        return last["version"] if last else None

    def read(self) -> DataFrame:
        version = self.live_version()
        if version is None:
            raise LookupError(f"nothing has been published under {self.root}")
        return self.staged(version)
