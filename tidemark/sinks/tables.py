"""Writing tables as Parquet files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.operators.lookup import project


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table.  For readers that must not see the change, publish instead."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def insert_columns(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Append the named columns in the given order; a failure is raised."""
    append(project(df, columns), path)
