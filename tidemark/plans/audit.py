"""One audit row per extracted table, and what is read off them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = (
    "table_name string, schema_name string, config_name string, database string,"
    " row_count bigint, estimated_size_mb double, chunked boolean, chunk_size bigint,"
    " num_chunks bigint, key_cols string, extracted_rows bigint, probe_error string,"
    " status string, error string"
)

OK, FAILED, PARTIAL, UNVERIFIED = "ok", "failed", "partial", "unverified"


def status_of(total: int | None, extracted: int, allow_partial: bool = False) -> str:
    """Whether an extraction that ran is complete."""
    if total is None:
        return UNVERIFIED
    if total == extracted:
        return OK
    return PARTIAL if allow_partial and extracted < total else FAILED


def audit_frame(spark: SparkSession, rows: Iterable[Mapping]) -> DataFrame:
    names = [part.split()[0] for part in AUDIT_SCHEMA.split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], AUDIT_SCHEMA)


def reconcile_counts(totals: DataFrame, extracted: DataFrame) -> DataFrame:
    """Expected against extracted rows per table; both have ``table_name, row_count``."""
    missing = F.col("total_rows") - F.col("extracted_rows")
    return (
        totals.select("table_name", F.col("row_count").alias("total_rows"))
        .join(
            extracted.select("table_name", F.col("row_count").alias("extracted_rows")),
            "table_name",
            "left",
        )
        .withColumn("extracted_rows", F.coalesce("extracted_rows", F.lit(0).cast("bigint")))
        .withColumn("missing_rows", missing)
        .withColumn("status", F.when(missing == 0, OK).otherwise(FAILED))
    )


def completeness(audit: DataFrame) -> DataFrame:
    """Expected, extracted and missing rows of every audited table."""
    return audit.select(
        "table_name",
        F.col("row_count").alias("total_rows"),
        "extracted_rows",
        (F.col("row_count") - F.col("extracted_rows")).alias("missing_rows"),
        "status",
    )


def outcome_totals(audit: DataFrame) -> DataFrame:
    """How many tables succeeded and how many failed."""
    failed: Column = F.col("status") == FAILED
    return audit.agg(F.count_if(~failed).alias("succeeded"), F.count_if(failed).alias("failed"))


def report(audit: DataFrame) -> DataFrame:
    """The run's report: per table rows and pages, or the error."""
    return audit.select(
        "table_name",
        F.col("extracted_rows").alias("rows"),
        "chunked",
        F.when(F.col("chunked"), F.col("num_chunks")).alias("chunks"),
        F.when(F.col("chunked"), F.col("chunk_size")).alias("chunk_size"),
        "status",
        "error",
    ).orderBy("table_name")


def append_run_log(audit: DataFrame, path: str) -> None:
    """Add the run's audit rows to the run log."""
    audit.write.mode("append").parquet(path)
