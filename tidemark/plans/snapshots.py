"""Loading full snapshots: replacing the last one, or extending its history."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.ordering import col
from tidemark.operators.history import IS_CURRENT, VALID_FROM, NotLater, next_versions, open_history, splice_history
from tidemark.sinks.published import PublishedTable
from tidemark.workspace import move, path_exists


def load_snapshot(table: PublishedTable, snapshot: DataFrame, expected_rows: int | None = None) -> str:
    """Make ``snapshot`` the table's content in one step that readers see whole."""
    return table.publish(snapshot, expected_rows)


class HistoryTable:
    """Type-2 history whose closed rows are written once and kept apart.

    Every load publishes a version that holds the current rows, and puts the
    rows it closed into a folder of their own.  The history is the live
    version's current rows and the closed rows of all loads, so a load costs
    what the current snapshot costs however long the history has grown, and
    versions that are no longer live can be removed.  Loads are dated by dates
    or time stamps of one type, no two alike.  One that arrives after a later
    one is spliced in: it writes the current rows, and the closed rows of loads
    dated after it once more; those of earlier loads stay as they are.  Columns
    may come and go between loads; they are null where a row knows none.

    With ``buckets`` the current rows are kept bucketed by key: a load then
    shuffles the arriving snapshot and nothing else.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 0):
        self.spark = spark
        self.keys = list(keys)
        self.table = PublishedTable(spark, root, self.keys, buckets)

    def closed_path(self, version: str) -> str:
        return f"{self.table.root}/closed/{version}"

    def load(self, snapshot: DataFrame, as_of: Column) -> str:
        live, replaced, reaches = self.table.live_version(), [], None
        if live is None:
            versions = open_history(self._bucketed(snapshot), as_of)
        elif (next_load := self._next_load(live, as_of)) is None:
            versions = self.versions_after(live, snapshot, as_of)
        else:
            until, replaced, reaches = next_load
            known = self._with_closed(self._current(live), replaced)
            versions = splice_history(known, self._bucketed(snapshot), self.keys, as_of, until)
        version, n_rows = self.table.stage(versions, [IS_CURRENT])
        n_closed = self._set_apart(version)
        dated = self.spark.range(1).select(as_of.cast("string")).first()[0]
        note = {"closed": n_closed, "as_of": dated, "reaches": reaches or dated, "replaces": replaced}
        self.table.flip(version, n_rows - n_closed, note=json.dumps(note))
        return version

    def _set_apart(self, version: str) -> int:
        """Move the rows that a staged version closed to where no clean-up of versions finds them."""
        folder = f"{self.table.version_path(version)}/{IS_CURRENT}=false"
        if not path_exists(self.spark, folder):
            return 0
        move(self.spark, folder, self.closed_path(version))
        name = self.table.catalog_name(version)
        if self.table.buckets and self.spark.catalog.tableExists(name):
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({IS_CURRENT}=false)")
        return self.spark.read.parquet(self.closed_path(version)).count()

    def versions_after(self, live: str, snapshot: DataFrame, as_of: Column) -> DataFrame:
        """What the next load writes, given the live version; it has to be later than all before it."""
        if self._next_load(live, as_of) is not None:
            raise NotLater("a later snapshot has been loaded")
        return next_versions(self._current(live), self._bucketed(snapshot), self.keys, as_of)

    def _bucketed(self, snapshot: DataFrame) -> DataFrame:
        """The snapshot dealt out as the buckets are, so that nothing else has to move."""
        if not self.table.buckets:
            return snapshot
        return snapshot.repartition(self.table.buckets, *[col(k) for k in self.keys])

    def _notes(self) -> dict[str, dict]:
        return {r["version"]: json.loads(r["note"]) for r in self.table.log().select("version", "note").collect()}

    def _closed(self, notes: dict[str, dict]) -> list[str]:
        """The loads whose closed rows count; those that a late one wrote again don't."""
        replaced = {v for note in notes.values() for v in note.get("replaces", ())}
        return [v for v, note in notes.items() if note["closed"] and v not in replaced]

    def _next_load(self, live: str, as_of: Column) -> tuple[Column, list[str], str] | None:
        """For a snapshot that arrives late: the date of the next one, whose closed rows may change, the last date of all.

        None if it is later than all, ``NotLater`` if one of its date was loaded.
        """
        kind = self.table.columns_of(live)[VALID_FROM].dataType
        one = self.spark.range(1).select(as_of.alias("as_of"))
        if one.schema["as_of"].dataType != kind:
            raise TypeError(f"the history is dated by {kind.simpleString()}, not {one.schema['as_of'].dataType.simpleString()}")
        notes = self._notes()
        loads = self.spark.createDataFrame(
            [(v, note["as_of"], note.get("reaches", note["as_of"])) for v, note in notes.items()],
            "version string, of string, reaches string",
        ).select("version", F.col("of").cast(kind).alias("of"), "reaches", F.col("reaches").cast(kind).alias("to"))
        last = loads.agg(F.max("of").alias("last"), F.count_if(F.col("of") == as_of).alias("alike")).select(
            F.col("last").cast("string"), (F.col("last") < as_of).alias("later"), "alike"
        ).first()
        if last["later"]:
            return None
        if last["alike"]:
            raise NotLater(f"a snapshot of that date was loaded; the last is of {last['last']}")
        following = loads.where(F.col("of") > as_of).agg(F.min("of").cast("string")).first()[0]
        until = F.lit(following).cast(kind)
        touched = {r["version"] for r in loads.where(F.col("to") >= until).select("version").collect()}
        return until, [v for v in self._closed(notes) if v in touched], last["last"]

    def _current(self, version: str) -> DataFrame:
        return self.table.staged(version).where(F.col(IS_CURRENT))

    def _live(self) -> str:
        live = self.table.live_version()
        if live is None:
            raise LookupError("no snapshot has been loaded")
        return live

    def current(self) -> DataFrame:
        """The rows that are valid now."""
        return self._current(self._live())

    def read(self) -> DataFrame:
        """The whole history; a folder of closed rows that is gone is an error, not a shorter history."""
        return self._with_closed(self.current(), self._closed(self._notes()))

    def _with_closed(self, current: DataFrame, loads: list[str]) -> DataFrame:
        """``current`` and the closed rows of the named loads."""
        gone = [v for v in loads if not path_exists(self.spark, self.closed_path(v))]
        if gone:
            raise LookupError(f"closed rows of {', '.join(sorted(gone))} are missing under {self.table.root}")
        if not loads:
            return current
        columns = StructType([f for f in current.schema.fields if f.name != IS_CURRENT])
        rows = self.spark.read.schema(columns).parquet(*[self.closed_path(v) for v in loads])
        return current.unionByName(rows.withColumn(IS_CURRENT, F.lit(False)))
