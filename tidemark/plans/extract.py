"""Extracting tables: probe, decide, read, land, audit.

A table is read once.  Its rows are counted by the job that lands them, and
whatever is done later reads the landed copy and not the source.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import page_count_of, size_mb_of
from tidemark.operators.chunking import (
    DEFAULT_CHUNK_SIZE,
    check_chunk_size,
    check_manifest,
    chunk_plan,
    manifest,
    tag_page,
)
from tidemark.operators.stats import SIZE_THRESHOLD_MB, should_chunk
from tidemark.plans.audit import FAILED, audit_frame, outcome_totals, status_of
from tidemark.workspace import run_dir

DEFAULT_SCHEMA = "raw"
DEFAULT_CONCURRENCY = 4


class ExtractionFailed(RuntimeError):
    """A table could not be extracted completely."""

    def __init__(self, message: str, audit: Mapping):
        super().__init__(message)
        self.audit = dict(audit)


@dataclass(frozen=True)
class Extraction:
    """A landed table and its audit row."""

    rows: DataFrame
    audit: dict

    def pages(self) -> DataFrame:
        """Planned pages against landed rows, with an error text where they differ."""
        total = self.audit["row_count"] or 0
        one_page = {"chunk_size": max(total, 1), "num_chunks": min(total, 1)}
        cut = self.audit if self.audit["chunked"] else {**self.audit, **one_page}
        planned = chunk_plan(audit_frame(self.rows.sparkSession, [cut]), cut["chunk_size"])
        found = manifest(self.rows, cut["chunk_size"])
        return check_manifest(planned, found.withColumn("table_name", F.lit(cut["table_name"])))


@dataclass(frozen=True)
class ExtractionRun:
    """All tables of a run.  A table that failed has an audit row but no frame."""

    frames: dict[str, DataFrame]
    audit: DataFrame

    def totals(self) -> DataFrame:
        return outcome_totals(self.audit)


def extract_table(
    source,
    table: str,
    schema: str | None = None,
    database: str | None = None,
    chunk_size: int | None = None,
    force_chunking: bool = False,
    allow_partial: bool = False,
    key: Sequence[str] = (),
    config_name: str | None = None,
    threshold_mb: float = SIZE_THRESHOLD_MB,
    landing: str | None = None,
) -> Extraction:
    """Land one table, in pages if it is large and has a key.

    ``schema=None`` means the default schema, ``''`` an unqualified name.
    """
    source = source.with_database(database)
    schema = DEFAULT_SCHEMA if schema is None else schema
    chunk_size = check_chunk_size(DEFAULT_CHUNK_SIZE if chunk_size is None else chunk_size)
    landing = landing or run_dir(source.spark, "landing")
    audit = {
        "table_name": table,
        "schema_name": schema,
        "config_name": config_name,
        "database": getattr(source, "database", None) or None,  # what is read, whatever was asked for
        "chunked": False,
        "chunk_size": None,
        "num_chunks": None,
        "row_count": None,
    }
    try:
        total = _probe(source, table, schema, audit)
        keys: tuple[str, ...] = ()
        if total is not None and should_chunk(total, chunk_size, threshold_mb, force_chunking):
            keys = tuple(key) or tuple(source.primary_key(table, schema))
        if keys:
            rows = source.read_paged(table, schema, keys, chunk_size)
            audit.update(
                chunked=True,
                key_cols=",".join(keys),
                chunk_size=chunk_size,
                num_chunks=page_count_of(total, chunk_size),
            )
        else:
            rows = tag_page(source.read(table, schema), 0)
        audit["extracted_rows"] = _land(rows, landing)
    except Exception as cause:
        audit.update(status=FAILED, error=str(cause))
        raise ExtractionFailed(f"{table}: {cause}", audit) from cause
    audit["status"] = status_of(total, audit["extracted_rows"], allow_partial)
    if audit["status"] == FAILED:
        audit["error"] = f"expected {total} rows, extracted {audit['extracted_rows']}"
        raise ExtractionFailed(f"{table}: {audit['error']}", audit)
    return Extraction(source.spark.read.parquet(landing), audit)


def _probe(source, table: str, schema: str, audit: dict) -> int | None:
    """The row count; a probe that fails leaves it unknown and the table is read whole."""
    try:
        total = source.row_count(table, schema)
    except Exception as cause:
        audit["probe_error"] = str(cause)
        return None
    audit.update(row_count=total, estimated_size_mb=size_mb_of(total))
    return total


def _land(rows: DataFrame, path: str) -> int:
    """Write the rows and count them on the way."""
    written = Observation()
    rows.observe(written, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return written.get["n"]


def _table_settings(tables: Sequence[str] | Mapping) -> dict[str, Mapping]:
    if isinstance(tables, Mapping):
        return {t: (s if isinstance(s, Mapping) else {}) for t, s in tables.items()}
    if isinstance(tables, (list, tuple)):
        return {t: {} for t in tables}
    raise ValueError(f"tables must be a list or a mapping, got {type(tables).__name__}")


def extract_tables(
    source,
    tables: Sequence[str] | Mapping,
    config_name: str | None = None,
    database: str | None = None,
    chunk_size: int | None = None,
    skip_on_error: bool = True,
    force_chunking: bool = False,
    allow_partial: bool = False,
    concurrency: int = DEFAULT_CONCURRENCY,
) -> ExtractionRun:
    """Land several tables; one that fails does not stop the others.

    Tables are extracted side by side, so that small ones fill the cluster while
    a large one finishes.  With ``skip_on_error=False`` the first error is raised.
    """
    settings = _table_settings(tables)
    spark: SparkSession = source.spark
    # Settles the shared folder before the tables start side by side.
    run_dir(spark, "landing")

    def one(name: str) -> Extraction | ExtractionFailed:
        own = settings[name]
        try:
            return extract_table(
                source,
                name,
                own.get("schema"),
                database,
                own.get("chunk_size", chunk_size),
                own.get("force_chunking", force_chunking),
                allow_partial,
                own.get("key", ()),
                config_name,
            )
        except ExtractionFailed as failure:
            if not skip_on_error:
                raise
            return failure

    with ThreadPoolExecutor(max_workers=max(1, concurrency)) as pool:
        futures = {name: pool.submit(inheritable_thread_target(spark)(one), name) for name in settings}
        results = {name: f.result() for name, f in futures.items()}
    frames = {n: r.rows for n, r in results.items() if isinstance(r, Extraction)}
    return ExtractionRun(frames, audit_frame(spark, [r.audit for r in results.values()]))
