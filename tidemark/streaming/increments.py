"""Incremental loads as a stream that stops when it has caught up."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.ordering import col
from tidemark.plans.load import not_landed
from tidemark.workspace import path_exists

# Below a table's folder: one row for each load, beside the loads' rows.
_LOADS = "_loads"
_LOADS_SCHEMA = "load bigint, offered bigint, landed bigint, repeated bigint, late bigint, high_micros bigint"
LOAD, DAY, LATE = "load", "event_date", "is_late"


def file_stream(
    spark: SparkSession,
    pattern: str,
    schema: T.StructType,
    format: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Files matching ``pattern`` as a stream; each is read once."""
    reader = spark.readStream.format(format).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(pattern)


def append_available(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    day_of: str | None = None,
    day_name: str = "event_date",
) -> StreamingQuery:
    """Append all that has arrived to ``path`` and stop.

    The checkpoint remembers which files are done, so a later call continues
    where this one ended, also after a failure.
    """
    if day_of:
        stream = stream.withColumn(day_name, col(day_of).cast("date"))
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if day_of:
        writer = writer.partitionBy(day_name)
    query = writer.start(path)
    query.awaitTermination()
    return query


def rows_appended(query: StreamingQuery) -> int:
    return sum(p["numInputRows"] for p in query.recentProgress)


def append_once(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    column: str,
    lookback: timedelta = timedelta(0),
) -> StreamingQuery:
    """Append each event that has arrived and is not there yet, however often it is delivered, and stop.

    Rows are filed by load and by the day of ``column``.  A micro-batch leaves
    out rows whose key it holds already for that day (the earliest stays; of
    equally early ones the least by content hash) or that earlier loads landed
    there: copies of an event carry one time stamp, so only the days that a
    batch speaks of are read, however old they are.  A null in a key is settled as in
    ``load.not_landed``.  Nothing arrives too late to land; rows from before the
    highest stamp of all earlier loads, less ``lookback``, are marked as late.

    A batch writes only the folder of its own number, so one that is run again
    after a failure replaces what it had written.  ``loads_of`` counts what each
    load was offered, landed, left out and found late.
    """

    def land(batch: DataFrame, load: int) -> None:
        spark = batch.sparkSession
        offered = batch.withColumn(DAY, col(column).cast("date"))
        counts = offered.groupBy(DAY).count().collect()  # one row a day
        n = sum(r["count"] for r in counts)
        no_key = F.lit(False)
        for k in keys:
            no_key = no_key | col(k).isNull()
        comparable = _comparable(batch)
        first = Window.partitionBy(DAY, *[col(k) for k in keys]).orderBy(col(column), F.xxhash64(*map(col, comparable)))
        single = offered.where(~no_key).withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")
        new = single.unionByName(offered.where(no_key).dropDuplicates(comparable))
        high = None
        if load and path_exists(spark, f"{path}/{_LOADS}"):
            high = loads_of(spark, path).where(F.col(LOAD) < load).agg(F.max("high")).select(F.unix_micros("max(high)")).first()[0]
            days = [r[DAY] for r in counts if r[DAY] is not None]
            reach = F.col(DAY).isin(days) | (F.col(DAY).isNull() if len(days) < len(counts) else F.lit(False))
            landed = _landed(spark, path, batch.schema).where((F.col(LOAD) < load) & reach)
            new = not_landed(new, landed.select(*new.columns), keys)
        stamp = F.unix_micros(col(column).cast("timestamp"))
        too_late = F.lit(False)
        if high is not None:
            too_late = F.coalesce(stamp < F.lit(high - lookback // timedelta(microseconds=1)), F.lit(False))
        kept = Observation()
        new = new.withColumn(LATE, too_late).observe(
            kept, F.count(F.lit(1)).alias("n"), F.count_if(F.col(LATE)).alias("late"), F.max(stamp).alias("high")
        )
        writer = new.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(DAY).parquet(f"{path}/{LOAD}={load}")
        got = kept.get
        entry = spark.createDataFrame([(load, n, got["n"], n - got["n"], got["late"], got["high"])], _LOADS_SCHEMA)
        entry.coalesce(1).write.mode("overwrite").json(f"{path}/{_LOADS}/{load}")

    query = (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _comparable(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "map<" not in df.schema[c].dataType.simpleString()]


def _landed(spark: SparkSession, path: str, rows: T.StructType) -> DataFrame:
    filed = [T.StructField(LATE, T.BooleanType()), T.StructField(LOAD, T.LongType()), T.StructField(DAY, T.DateType())]
    return spark.read.schema(T.StructType([*rows.fields, *filed])).parquet(path)


def landed_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows that were landed once, with ``load``, ``event_date`` and ``is_late``."""
    return spark.read.parquet(path)


def loads_of(spark: SparkSession, path: str) -> DataFrame:
    """``load, offered, landed, repeated, late, high`` of each load."""
    log = spark.read.schema(_LOADS_SCHEMA).option("recursiveFileLookup", "true").json(f"{path}/{_LOADS}")
    return log.withColumn("high", F.timestamp_micros("high_micros")).drop("high_micros")
