"""Where intermediate tables live, and who removes them.

Some operators cut a plan by writing a table and reading it back.  Those tables
go to the folder the cluster shares between its executors, which is whatever
``spark.checkpoint.dir`` names.  Only a session that runs in one process and has
no such setting uses its own warehouse folder instead.

The tables belong to the session: a DataFrame may read them until it has been
written or collected, and ``release`` removes them all once that is done.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder."""
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError(
            f"{CHECKPOINT_DIR} is not set; name a folder that every executor can reach"
        )
    return spark.conf.get(WAREHOUSE_DIR).rstrip("/")


def session_dir(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this session."""
    return f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}"


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A path under the session's part of the shared folder that no other run uses."""
    return f"{session_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Remove all intermediate tables of this session; what reads them can't be run again."""
    path, fs = _hadoop(spark, session_dir(spark))
    fs.delete(path, True)


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table that was written.

    Unlike a cache this survives the loss of executors, and every later reader
    sees the same rows even where ``df`` itself is not deterministic.
    """
    path = run_dir(df.sparkSession, purpose)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder and all below it, if it is there."""
    hadoop_path, fs = _hadoop(spark, path)
    fs.delete(hadoop_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, on whatever filesystem it names."""
    hadoop_path, fs = _hadoop(spark, path)
    return fs.exists(hadoop_path)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """The names directly below a folder; none if there is no such folder."""
    hadoop_path, fs = _hadoop(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(hadoop_path))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within one filesystem."""
    (source_path, fs), (target_path, _) = _hadoop(spark, source), _hadoop(spark, target)
    fs.mkdirs(target_path.getParent())
    if not fs.rename(source_path, target_path):
        raise OSError(f"{source} could not be moved to {target}")


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small new file; False, and nothing done, if there is one already."""
    hadoop_path, fs = _hadoop(spark, path)
    fs.mkdirs(hadoop_path.getParent())
    if fs.exists(hadoop_path):
        return False
    try:
        out = fs.create(hadoop_path, False)
    except Exception as cause:
        if "already exists" in str(cause) or "AlreadyExists" in str(cause):
            return False
        raise
    try:
        out.write(text.encode())
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file; None if there is none."""
    hadoop_path, fs = _hadoop(spark, path)
    if not fs.exists(hadoop_path):
        return None
    opened = fs.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()
