"""Profiles of a growing drop of Parquet files, kept per file and merged.

A profile holds rows, nulls, least and greatest value and a distinct sketch of
every column.  All of these merge, so files that were profiled before are never
read again: an arrival costs what its own files cost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.ordering import col
from tidemark.workspace import file_names

_FILE = ["file_path", "file_size", "file_modification_time"]
_FILE_SCHEMA = "file_path string, file_size bigint, file_modification_time timestamp"


def stamped_files(spark: SparkSession, path: str) -> DataFrame:
    """The files below ``path`` as Spark's scans name them, with size and time; only the listing is read."""
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as cause:
        if cause.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _FILE_SCHEMA)
    return found.select(*[F.col(f"_metadata.{c}").alias(c) for c in _FILE])


def _sketched(c: Column, kind: T.DataType) -> Column:
    """The value as the sketch takes it; values that are equal stay equal."""
    if isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)):
        return c
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # Adding zero turns a negative zero, which equals zero, into zero.
        return (c + F.lit(0.0)).cast("string")
    return c.cast("string")


def _measured(name: str, kind: T.DataType) -> Column:
    """The mergeable profile of one column; values of nested types are only counted."""
    c = col(name)
    nulls = F.count_if(c.isNull()).alias("n_null")
    if not isinstance(kind, T.AtomicType) or isinstance(kind, T.VariantType):
        none = F.lit(None)
        return F.struct(nulls, none.cast("string").alias("low"), none.cast("string").alias("high"), none.cast("binary").alias("sketch"))
    return F.struct(
        nulls, F.min(c).alias("low"), F.max(c).alias("high"), F.hll_sketch_agg(_sketched(c, kind)).alias("sketch")
    )


def profile_files(scan: DataFrame) -> DataFrame:
    """``file_path, n_rows, c0, c1, ...``: each file's profile, the columns by their place.

    ``scan`` reads Parquet files.  One pass; each task folds the rows of a file
    before the shuffle, so one very large file is spread over its tasks.
    """
    columns = [_measured(f.name, f.dataType).alias(f"c{i}") for i, f in enumerate(scan.schema.fields)]
    in_file = scan.withColumn("__file", F.col("_metadata.file_path"))
    return in_file.groupBy("__file").agg(F.count(F.lit(1)).alias("n_rows"), *columns).withColumnRenamed("__file", "file_path")


def merge_profiles(kept: DataFrame, names: Sequence[str]) -> DataFrame:
    """``column_name, n_rows, n_null, low, high, n_distinct`` of all files of ``kept`` together.

    ``low`` and ``high`` are compared in the column's own type and put out as
    text, ``n_distinct`` is an estimate.  Without files or rows they are null,
    and the counts are zero.
    """
    none = F.lit(0).cast("bigint")
    merged = [F.coalesce(F.sum("n_rows"), none).alias("n_rows")]
    for i in range(len(names)):
        part = F.col(f"c{i}")
        merged += [
            F.coalesce(F.sum(part.getField("n_null")), none).alias(f"n{i}"),
            F.min(part.getField("low")).cast("string").alias(f"l{i}"),
            F.max(part.getField("high")).cast("string").alias(f"h{i}"),
            F.hll_union_agg(part.getField("sketch")).alias(f"s{i}"),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            "n_rows",
            F.col(f"n{i}").alias("n_null"),
            F.col(f"l{i}").alias("low"),
            F.col(f"h{i}").alias("high"),
            F.when(F.col(f"l{i}").isNotNull(), F.hll_sketch_estimate(f"s{i}")).alias("n_distinct"),
        )
        for i, name in enumerate(names)
    ]
    return kept.agg(*merged).select(F.inline(F.array(*rows)))


class KeptProfiles:
    """The profile of the Parquet files below ``path``, kept per file below ``root``.

    ``columns`` is what the files are read as: a column that a file lacks is
    null in all its rows.  Profiles of another set of columns are kept apart.  A
    file is known by its path, size and time; one that was written anew is read
    anew, and one that is gone takes no part.
    """

    def __init__(self, spark: SparkSession, root: str, path: str, columns: T.StructType):
        self.spark, self.path, self.columns = spark, path, columns
        self.kept_path = f"{root.rstrip('/')}/{hashlib.sha256(columns.json().encode()).hexdigest()[:16]}"

    def _scan(self, paths: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(self.columns).parquet(*paths)

    def kept(self) -> DataFrame:
        """One row per profiled file, also of files that are gone."""
        nothing = self.spark.createDataFrame([], self.columns)
        shape = [F.lit(None).cast(kind).alias(c) for c, kind in
                 (("file_path", "string"), ("file_size", "bigint"), ("file_modification_time", "timestamp"))]
        profiled = [_measured(f.name, f.dataType).alias(f"c{i}") for i, f in enumerate(self.columns.fields)]
        empty = nothing.agg(F.count(F.lit(1)).alias("n_rows"), *profiled).select(*shape, "*").where("file_path is not null")
        if not file_names(self.spark, self.kept_path):
            return empty
        return self.spark.read.schema(empty.schema).parquet(self.kept_path)

    def pending(self) -> DataFrame:
        """The files that have not been profiled as they are now."""
        return stamped_files(self.spark, self.path).join(self.kept().select(*_FILE), _FILE, "left_anti")

    def update(self) -> list[str]:
        """Profile the pending files, and no others; their paths.

        The paths go through the driver, as in any scan that names its files.
        Two updates at once may profile a file twice, which ``merged`` settles.
        """
        pending = [tuple(r) for r in self.pending().collect()]
        if not pending:
            return []
        paths = [p for p, _, _ in pending]
        listed = self.spark.createDataFrame(pending, _FILE_SCHEMA)
        # A file without rows has no group of its own.
        rows = listed.join(profile_files(self._scan(paths)), "file_path", "left").fillna(0, ["n_rows"])
        rows.select(*self.kept().columns).write.mode("append").parquet(self.kept_path)
        return paths

    def merged(self) -> DataFrame:
        """The profile of all files that are there now and have been profiled; see ``merge_profiles``."""
        here = self.kept().dropDuplicates(_FILE).join(stamped_files(self.spark, self.path), _FILE, "left_semi")
        return merge_profiles(here, self.columns.fieldNames())


def footer_counts(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """One row: ``n_rows``, and for each of ``columns`` how many of its values are not null, from Parquet footers.

    No column is decoded.  The footers must hold null counts of ``columns``, as
    those of Spark's own files do.  The aggregation is pushed into the reader of
    a session of its own, so the caller's settings stay as they are; collect the
    result rather than join it.
    """
    side = spark.newSession()
    side.conf.set("spark.sql.sources.useV1SourceList", "")
    side.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    counts = [F.count(col(c)).alias(c) for c in columns]
    return side.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"), *counts)
