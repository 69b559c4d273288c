"""Relational databases through Spark's JDBC source and sink.

No connection is opened outside Spark: counts, key look-ups and rows all go
through ``spark.read``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import types as T

from tidemark.functions.ordering import col
from tidemark.functions.scalars import qualified_name
from tidemark.operators.chunking import page_rows, page_table_by_key, with_row_position
from tidemark.sources.predicates import (
    count_query,
    ends_query,
    hash_predicates,
    key_query,
    range_predicates,
    type_query,
)
from tidemark.workspace import materialise

# Column types Spark can read by even strides.
_STRIDED = (T.NumericType, T.DateType, T.TimestampType)
# Column types whose values can be written into range predicates.
_CUTTABLE = (T.NumericType, T.DateType, T.StringType)

DEFAULT_CONNECTIONS = 32
ROWS_PER_RANGE = 1_000_000
FETCH_SIZE = 10_000

# Fixed value: the most connections a write opens at once, unless the source says otherwise.
WRITE_CONNECTIONS = 200
WRITE_BATCH = 10_000


@dataclass(frozen=True)
class JdbcSource:
    """A database reached by URL; ``kind`` is ``sqlserver`` or ``postgres``.

    ``connections`` is how many parts the key columns are read in.  The rows are
    read in ranges of about ``rows_per_range``, however many that makes, so that
    a lost task repeats little; how many run at once is up to the cores of the
    cluster, or to ``max_connections``, which puts several ranges into one task.
    Options in ``extra`` go before all others.
    """

    spark: SparkSession
    kind: str
    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    database: str = ""
    connections: int = DEFAULT_CONNECTIONS
    extra: Mapping[str, str] = field(default_factory=dict)
    rows_per_range: int = ROWS_PER_RANGE
    max_connections: int | None = None
    write_connections: int = WRITE_CONNECTIONS
    write_batch: int = WRITE_BATCH

    def with_database(self, database: str | None) -> JdbcSource:
        """PostgreSQL has its database in the URL: there the name is not taken, so it is not reported either."""
        return replace(self, database=database) if database and self.kind == "sqlserver" else self

    def full_url(self) -> str:
        """SQL Server takes the database at the end of the URL; PostgreSQL has it inside."""
        return self.url + self.database if self.kind == "sqlserver" else self.url

    def options(self, **more: str) -> dict[str, str]:
        opts = {"url": self.full_url(), "driver": self.driver, "fetchsize": str(FETCH_SIZE)}
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        return {**opts, **more, **self.extra}

    # --- reading ---------------------------------------------------------------

    def _load(self, **options: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options(**options)).load()

    def read(self, table: str, schema: str | None = None) -> DataFrame:
        """The whole table through one connection; filters and columns are pushed down."""
        return self._load(dbtable=qualified_name(table, schema))

    def query(self, sql: str) -> DataFrame:
        return self._load(query=sql)

    def row_count(self, table: str, schema: str | None = None) -> int:
        return int(self.query(count_query(table, schema)).first()[0])

    def primary_key(self, table: str, schema: str | None = None) -> tuple[str, ...]:
        """All key columns in key order, read by position since label case varies."""
        rows = self.query(key_query(table, schema, self.kind)).collect()
        return tuple(r[0] for r in sorted(rows, key=lambda r: r[1]))

    def read_ranges(
        self, table: str, schema: str | None, predicates: Sequence[str]
    ) -> DataFrame:
        """One partition per predicate."""
        opts = self.options()
        return self.spark.read.jdbc(
            opts.pop("url"),
            qualified_name(table, schema),
            predicates=list(predicates),
            properties=opts,
        )

    def stride_options(self, table: str, schema: str | None, column: str, low, high) -> dict:
        return self.options(
            dbtable=qualified_name(table, schema),
            partitionColumn=column,
            lowerBound=str(low),
            upperBound=str(high),
            numPartitions=str(self.connections),
        )

    def read_strided(self, table: str, schema: str | None, column: str) -> DataFrame:
        """Read in parallel by even strides of one numeric, date or timestamp column."""
        low, high = self.query(ends_query(table, schema, column)).first()
        if low is None:
            return self.read(table, schema)
        options = self.stride_options(table, schema, column, low, high)
        return self.spark.read.format("jdbc").options(**options).load()

    def read_paged(
        self, table: str, schema: str | None, keys: Sequence[str], chunk_size: int
    ) -> DataFrame:
        """All rows with their page number, read in parallel by exact key ranges.

        The key columns are read once, on their own, and kept: they fix which
        pages there are.  Numbers, dates and times are read by even strides,
        other keys dealt out by a hash, either way over several connections.
        The rows are then read in ranges that each hold a whole number of
        pages, so that no range is much larger than another and the database
        never sorts the table or skips over rows.  If the columns turn out not
        to tell rows apart, the rows are landed first and paged there.
        """
        fields = self.read(table, schema).schema
        types = [fields[k].dataType for k in keys]
        if isinstance(types[0], _STRIDED):
            by_key = self.read_strided(table, schema, keys[0])
        else:
            by_key = self.read_ranges(table, schema, hash_predicates(keys[0], self.connections, self.kind))
        key_rows = materialise(by_key.select(*[col(k) for k in keys]), "keys")
        pages = page_table_by_key(key_rows, keys, chunk_size)
        rows = by_key
        if pages is not None and all(isinstance(t, _CUTTABLE) for t in types):
            n_ranges = max(1, -(-pages.n_rows // self.rows_per_range))
            cuts = pages.every(n_ranges)
            rows = self.read_ranges(
                table, schema, range_predicates(keys, cuts, self.kind, self.key_types(table, schema, keys))
            )
            if self.max_connections and len(cuts) >= self.max_connections:
                rows = rows.coalesce(self.max_connections)
        if pages is not None and pages.can_be_looked_up():
            return pages.tag(rows)
        return page_rows(with_row_position(rows), keys, chunk_size)

    def key_types(self, table: str, schema: str | None, keys: Sequence[str]) -> dict[str, str]:
        """The database's own types of the key columns."""
        found = {r[0]: r[1] for r in self.query(type_query(table, schema)).collect()}
        return {k: found[k] for k in keys if k in found}

    # --- writing ---------------------------------------------------------------

    def write(
        self, df: DataFrame, table: str, schema: str | None = None, mode: str = "append"
    ) -> None:
        """Append, or overwrite by emptying the table, which keeps its keys."""
        self.writer(df, table, schema, mode).save()

    def writer(
        self, df: DataFrame, table: str, schema: str | None = None, mode: str = "append"
    ) -> DataFrameWriter:
        return df.write.format("jdbc").mode(mode).options(**self.write_options(table, schema))

    def write_options(self, table: str, schema: str | None = None) -> dict[str, str]:
        return self.options(
            dbtable=qualified_name(table, schema),
            truncate="true",
            numPartitions=str(self.write_connections),
            batchsize=str(self.write_batch),
        )
