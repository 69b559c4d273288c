"""Tables and drops that are files on any filesystem Spark can reach."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.chunking import page_rows, page_rows_by_kept_keys, scan_position
from tidemark.operators.keys import minimal_keys

_LISTED = "path string, length bigint, modificationTime timestamp"


def list_files(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """Path, size and time of the files whose path below ``root`` starts with ``prefix``.

    The prefix is taken literally.  No match gives no rows.  Files whose names
    begin with ``_`` or ``.`` are not listed: Spark takes them for its own.
    Only the listing is read: the content column is pruned away.
    """
    literal = re.sub(r"([\\*?\[\]{}])", r"\\\1", prefix)
    pattern = f"{root.rstrip('/')}/{literal}*"
    try:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern)
    except AnalysisException as cause:
        if cause.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LISTED)
    return listed.select("path", "length", "modificationTime")


@dataclass(frozen=True)
class FileSource:
    """Tables kept as files, one path per table.

    ``layout`` turns a table name (and schema) into a path below ``root``;
    ``keys`` names the key columns of tables that have a key.  For a table that
    is not named there, keys of up to ``search_keys`` columns are looked for in
    its rows (0: not at all), and the first of the shortest is taken.
    """

    spark: SparkSession
    root: str
    format: str = "parquet"
    layout: str = "{table}.parquet"
    keys: Mapping[str, Sequence[str]] = field(default_factory=dict)
    options: Mapping[str, str] = field(default_factory=dict)
    search_keys: int = 0
    kind: str = "files"

    def path(self, table: str, schema: str | None = None) -> str:
        return f"{self.root.rstrip('/')}/{self.layout.format(table=table, schema=schema or '')}"

    def with_database(self, database: str | None) -> FileSource:
        return self

    def read(
        self, table: str, schema: str | None = None, columns: T.StructType | None = None
    ) -> DataFrame:
        reader = self.spark.read.format(self.format).options(**self.options)
        if columns is not None:
            reader = reader.schema(columns)
        return reader.load(self.path(table, schema))

    def row_count(self, table: str, schema: str | None = None) -> int:
        return self.read(table, schema).agg(F.count(F.lit(1))).first()[0]

    def primary_key(self, table: str, schema: str | None = None) -> tuple[str, ...]:
        if table in self.keys or not self.search_keys:
            return tuple(self.keys.get(table, ()))
        found = minimal_keys(self.read(table, schema), self.search_keys)
        return found[0] if found else ()

    def read_paged(
        self, table: str, schema: str | None, keys: Sequence[str], chunk_size: int
    ) -> DataFrame:
        """All rows with their page number.

        Parquet tells where each row stands, which orders the copies of a key.
        """
        scan = self.read(table, schema)
        if self.format == "parquet":
            return page_rows(scan_position(scan), keys, chunk_size)
        return page_rows_by_kept_keys(scan, keys, chunk_size)
