"""Loading snapshots and increments into the raw layer."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.ordering import col
from tidemark.functions.sizes import small_side
from tidemark.workspace import path_exists

# Readers of the table skip a folder with this kind of name.
_LOG = "_watermarks"
_LOG_SCHEMA = "high string"


def after_watermark(df: DataFrame, column: str, last: Column) -> DataFrame:
    """Rows past the watermark; the comparison reaches the source."""
    return df.where(col(column) > last)


Mark = datetime | date | int | Decimal


@dataclass(frozen=True)
class Increment:
    """What one incremental load added, and how far it got.

    ``added`` counts all rows, ``unstamped`` those of them without a watermark
    value.  ``high`` is naive for zoneless timestamps, and in UTC for instants.
    ``late`` counts rows that came too late for the lookback and were set apart;
    None if the load was not asked to look for them.
    """

    added: int
    high: Mark | None
    unstamped: int = 0
    late: int | None = None


def high_watermark(df: DataFrame, column: str) -> Mark | None:
    highest = df.agg(F.max(col(column))).first()[0]
    if highest is not None and isinstance(df.schema[column].dataType, T.TimestampType):
        return highest.astimezone(timezone.utc)
    return highest


def mark(df: DataFrame, column: str, value: Mark) -> Column:
    """``value`` as a literal of the column's own type, whatever zone is set where."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        seconds = int(value.replace(microsecond=0).timestamp())
        return F.timestamp_micros(F.lit(seconds * 1_000_000 + value.microsecond))
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(value.isoformat(" ")).cast("timestamp_ntz")
    if isinstance(kind, (T.DateType, T.IntegralType, T.DecimalType)):
        return F.lit(value).cast(kind)
    raise TypeError(f"{column}: {kind.simpleString()} cannot be a watermark")


def _before(value: Mark, lookback: timedelta | int) -> Mark:
    """``value`` less the lookback, which is a number for columns of numbers."""
    if isinstance(value, date) == isinstance(lookback, timedelta):
        return value - lookback
    if not lookback:
        return value
    raise TypeError(f"a lookback of {lookback!r} does not fit a watermark of {value!r}")


def increment_of(
    source: DataFrame,
    landed: DataFrame | None,
    column: str,
    keys: Sequence[str],
    low: Mark | None,
    high: Mark | None,
    lookback: timedelta | int = timedelta(0),
) -> DataFrame:
    """Rows up to ``high`` that have not been landed yet.

    Reading starts at the watermark itself, or ``lookback`` before it, and rows
    whose key is already landed are left out.  So a row that shares the last
    timestamp, or arrives late within the lookback, is neither lost nor doubled.
    Both sides are limited to that window.  Rows without a timestamp belong to
    every window.  A null in a key equals a null; since it does not tell rows
    apart, such rows count as landed only if all their values are.
    """
    unstamped = col(column).isNull()
    rows = source.where(unstamped if high is None else unstamped | (col(column) <= mark(source, column, high)))
    if landed is None:
        return rows
    if low is not None:
        recent = unstamped | (col(column) >= mark(source, column, _before(low, lookback)))
        rows, landed = rows.where(recent), landed.where(recent)
    return not_landed(rows, landed, keys)


def not_landed(rows: DataFrame, landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` whose key is not among ``landed``; with a null in the key, those that differ in any value."""
    names = [c for c in rows.columns if "map<" not in rows.schema[c].dataType.simpleString()]
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | col(k).isNull()
    content = F.when(no_key, F.xxhash64(*[col(c) for c in names]))
    known = landed.select(*[col(k).alias(f"__k{i}") for i, k in enumerate(keys)], content.alias("__c")).distinct()
    asked = rows.withColumn("__own", content)
    same = F.col("__own").eqNullSafe(F.col("__c"))
    for i, k in enumerate(keys):
        same = same & col(k).eqNullSafe(F.col(f"__k{i}"))
    return asked.join(small_side(known), same, "left_anti").drop("__own")


def late_rows(
    source: DataFrame, landed: DataFrame, column: str, keys: Sequence[str], low: Mark, lookback: timedelta | int = timedelta(0)
) -> DataFrame:
    """Rows from before the watermark less the lookback whose key never landed."""
    before = col(column) < mark(source, column, _before(low, lookback))
    return not_landed(source.where(before), landed.where(before), keys)


def _stored_watermark(spark: SparkSession, path: str, kind: T.DataType) -> Mark | None:
    """The furthest mark any load has stored; time stamps are kept as text that sorts like time."""
    if not path_exists(spark, f"{path}/{_LOG}"):
        return None
    log = spark.read.schema(_LOG_SCHEMA).json(f"{path}/{_LOG}")
    stamped = isinstance(kind, (T.TimestampType, T.TimestampNTZType))
    latest = log.agg(F.max("high" if stamped else F.col("high").cast(kind))).first()[0]
    return datetime.fromisoformat(latest) if stamped and latest else latest


def _store_watermark(spark: SparkSession, path: str, high: Mark) -> None:
    # Time stamps are always written with microseconds, so that text order is time order.
    text = high.isoformat(timespec="microseconds") if isinstance(high, datetime) else str(high)
    entry = spark.range(1).select(F.lit(text).alias("high"))
    entry.coalesce(1).write.mode("append").json(f"{path}/{_LOG}")


def load_increment(
    source: DataFrame,
    path: str,
    column: str,
    keys: Sequence[str],
    lookback: timedelta | int = timedelta(0),
    day_column: str | None = None,
    late_path: str | None = None,
) -> Increment:
    """Append what is new in ``source`` to the table at ``path``.

    The watermark may be a time stamp, a date or a whole number.  The upper end
    is fixed before reading.  The watermark is stored after the rows are; should
    that be missed, the next load reads more and, since it leaves out landed
    keys, still adds the right rows.  With ``day_column`` the rows are filed
    under the day of their timestamp, whichever load they came with, and only
    the days in reach are read again.  Rows without a watermark value are landed
    too, once for each key, and counted.

    With ``late_path`` rows that come too late for the lookback and never landed
    are appended to the table there, each once, and counted.  With
    ``day_column`` only the days that such rows claim are read for that.
    """
    spark = source.sparkSession
    kind = source.schema[column].dataType
    if day_column and isinstance(kind, T.NumericType):
        raise TypeError(f"{column} is a number and has no day")
    landed, low, everything = None, None, None
    if path_exists(spark, path):
        landed = everything = spark.read.schema(source.schema).parquet(path)
        stored = _stored_watermark(spark, path, kind)
        low = high_watermark(landed, column) if stored is None else stored
        if day_column and low is not None:
            # One day more, should the session's zone have been another one then.
            first_day = F.date_sub(mark(source, column, _before(low, lookback)).cast("date"), 1)
            columns = T.StructType([*source.schema.fields, T.StructField(day_column, T.DateType())])
            landed = everything = spark.read.schema(columns).parquet(path)
            landed = landed.where(col(day_column).isNull() | (col(day_column) >= first_day)).drop(day_column)
    reach = source
    if low is not None:
        reach = source.where(col(column) >= mark(source, column, _before(low, lookback)))
    high = high_watermark(reach, column)
    late = None if late_path is None else _set_late_apart(source, everything, late_path, column, keys, low, lookback, day_column)
    written = Observation()
    new = increment_of(source, landed, column, keys, low, high, lookback)
    if day_column:
        new = new.withColumn(day_column, col(column).cast("date"))
    new = new.observe(written, F.count(F.lit(1)).alias("n"), F.count_if(col(column).isNull()).alias("unstamped"))
    new.write.mode("append").partitionBy(*([day_column] if day_column else [])).parquet(path)
    reached = low if high is None else high if low is None else max(high, low)
    if high is not None:
        _store_watermark(spark, path, reached)
    counted = written.get
    return Increment(counted["n"], reached, counted["unstamped"], late)


def _set_late_apart(
    source: DataFrame,
    landed: DataFrame | None,
    late_path: str,
    column: str,
    keys: Sequence[str],
    low: Mark | None,
    lookback: timedelta | int,
    day_column: str | None,
) -> int:
    if landed is None or low is None:
        return 0
    spark = source.sparkSession
    if day_column:
        old = source.where(col(column) < mark(source, column, _before(low, lookback)))
        span = old.agg(F.min(col(column).cast("date")), F.max(col(column).cast("date"))).first()
        # one day more on either side, should the session's zone have been another one then
        reach = col(day_column).between(F.date_sub(F.lit(span[0]).cast("date"), 1), F.date_add(F.lit(span[1]).cast("date"), 1))
        landed = landed.where(reach).drop(day_column)
    late = late_rows(source, landed, column, keys, low, lookback)
    if path_exists(spark, late_path):
        late = not_landed(late, spark.read.schema(source.schema).parquet(late_path), keys)
    written = Observation()
    late.observe(written, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(late_path)
    return written.get["n"]
