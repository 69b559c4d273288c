"""Exact, complete pages of a table by key.

A page is ``chunk_size`` consecutive rows in key order.  Ranking every row of a
wide table would shuffle all of it, so only the key columns are ranked: the keys
found at the page starts are kept (one per page) and the rows then look their
page up among them without moving.

The ranking never puts the table, or one hot key, in a single task.  Buckets are
cut at sampled key tuples, counted, and numbered one by one.  The order is
extended by each row's physical position, which is unique, so that buckets and
pages can cut through the copies of a key.  Parquet scans have positions; other
rows are ordered by key alone as long as no cut falls between copies, and get
positions by being written if one does.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.ordering import col, key_tuple, with_position
from tidemark.functions.scalars import page_count_of
from tidemark.functions.sizes import row_bytes, small_side
from tidemark.workspace import materialise

CHUNK_ID = "_chunk_id"

# Fixed value: rows per page if nothing else is asked for.
DEFAULT_CHUNK_SIZE = 100_000

# Sizes that bound what one task or the driver holds.
ROWS_PER_BUCKET = 1_000_000
SAMPLES_PER_BUCKET = 30
SAMPLES_PER_TASK = 100_000
BUCKETS_PER_CUT = 8
MIN_ROWS_PER_BUCKET = 20 * SAMPLES_PER_BUCKET
MAX_BOUND_BYTES = 128 * 1024 * 1024

# Where one plan takes over from another; the rows are the same on both sides.
MAX_PAGE_STARTS = 2_000_000
MAX_TOP_ROWS = 100_000

FILE = "__file"
ROW = "__row"
POSITION = (FILE, ROW)

_BUCKET, _BASE, _IDX, _TIED, _CONTENT = "__bucket", "__base", "__idx", "__tied", "__content"

# Operations that keep a scan's rows apart, so that its positions stay unique.
_ROW_BY_ROW = {"Project", "Filter", "SubqueryAlias", "LogicalRelation"}


class TiedKeys(Exception):
    """The key does not tell rows apart where a cut has to be made."""


@dataclass(frozen=True)
class Cuts:
    """The row indexes at which to cut: every ``step`` rows, or those listed."""

    step: int = 0
    listed: tuple[int, ...] = ()

    def count(self, n_rows: int) -> int:
        return page_count_of(n_rows, self.step) if self.step else len(self.listed)

    def any_in(self, low: Column, high: Column) -> Column:
        """Whether some cut lies at ``low`` or later, before ``high``."""
        if self.step:
            step = F.lit(self.step)
            return F.call_function("div", high - 1, step) * step >= F.greatest(low, F.lit(1))
        return F.exists(F.lit(list(self.listed)), lambda at: (low <= at) & (at < high))

    def at(self, index: Column) -> Column:
        if self.step:
            return (index % self.step == 0) & (index > 0)
        return index.isin(*self.listed)


def check_chunk_size(chunk_size: int) -> int:
    if chunk_size < 1:
        raise ValueError(f"chunk size must be at least 1, got {chunk_size}")
    return chunk_size


def scan_position(scan: DataFrame) -> DataFrame:
    """A Parquet scan with each row's file and row number.

    The file is kept as a hash.  Should two ever collide, the order has ties and
    a cut between them is refused, not guessed.
    """
    return scan.select(
        "*",
        F.xxhash64("_metadata.file_path").alias(FILE),
        F.col("_metadata.row_index").alias(ROW),
    )


def _scanned_position(df: DataFrame) -> DataFrame | None:
    """``df`` with row positions if it has them, or is no more than a Parquet scan; else None."""
    if set(POSITION) <= set(df.columns):
        return df
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in _ROW_BY_ROW and node.children().size() == 1:
        node = node.children().head()
    if node.nodeName() not in _ROW_BY_ROW:
        return None
    try:
        return scan_position(df)
    except AnalysisException:  # a scan of files without row numbers
        return None


def with_row_position(df: DataFrame) -> DataFrame:
    """``df`` with row positions: those of its scan, else those of a written copy."""
    found = _scanned_position(df)
    return scan_position(materialise(df, "positioned")) if found is None else found


def rank(
    df: DataFrame,
    keys: Sequence[str],
    n_rows: int,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Number the rows of ``df`` in the order of ``keys``.

    With ``cuts`` only the buckets that some cut falls into are kept.  The others
    need no order, and are dropped before anything is shuffled; so the fewer the
    cuts, the finer the buckets are made.
    """
    n_buckets = page_count_of(n_rows, rows_per_bucket)
    if n_buckets > 1 and cuts is not None:
        finer = max(n_buckets, cuts.count(n_rows)) * BUCKETS_PER_CUT
        n_buckets = max(n_buckets, min(finer, n_rows // MIN_ROWS_PER_BUCKET))
    bounds, n_bounds = None, 0
    if n_buckets > 1:
        bounds, n_bounds = _bucket_bounds(df, keys, n_rows, n_buckets, rows_per_bucket)
    based = with_position(df, keys, bounds, n_bounds, _BUCKET).withColumn(_BASE, F.lit(0))
    if n_bounds:
        based = based.drop(_BASE).join(small_side(_bucket_bases(based, cuts)), _BUCKET)
    in_bucket = Window.partitionBy(_BUCKET).orderBy(*[col(k) for k in keys])
    rows = based.withColumn(_IDX, F.row_number().over(in_bucket) - 1 + F.col(_BASE))
    tied = F.lag(key_tuple(keys)).over(in_bucket).eqNullSafe(key_tuple(keys))
    return rows.withColumn(_TIED, tied).drop(_BUCKET, _BASE)


def _bucket_bounds(
    df: DataFrame, keys: Sequence[str], n_rows: int, n_buckets: int, rows_per_bucket: int
) -> tuple[DataFrame, int]:
    """Key tuples that cut ``df`` into buckets of about the same size.

    The sample only balances the buckets; their exact sizes are counted later.
    A tuple that is drawn again and again has more copies than a bucket may hold.
    Should the tuples be so long that they exceed ``MAX_BOUND_BYTES``, fewer are
    kept and buckets get larger, which sorting them can bear.
    """
    wanted = n_buckets * SAMPLES_PER_BUCKET
    key_columns = [col(k) for k in keys]
    sampled = df.select(*key_columns).sample(fraction=min(1.0, wanted / n_rows), seed=7)
    spread = sampled.repartitionByRange(-(-wanted // SAMPLES_PER_TASK), *key_columns)
    # Ranges are sorted and numbered one by one; the lower bits are the place in the range.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = spread.sortWithinPartitions(*key_columns).withColumn(_IDX, place)
    every = numbered.where(F.col(_IDX) % SAMPLES_PER_BUCKET == SAMPLES_PER_BUCKET // 2)
    bounds = materialise(every.groupBy(*key_columns).agg(F.count(F.lit(1)).alias(_TIED)), "bounds")
    n_bounds, most, size = _measured(bounds)
    if most > 1 and (most - 1) * n_rows > rows_per_bucket * n_buckets:
        raise TiedKeys(f"copies of one key of {list(keys)} fill several buckets")
    if size > MAX_BOUND_BYTES:
        fewer = F.pmod(F.xxhash64(*key_columns), F.lit(-(-size // MAX_BOUND_BYTES))) == 0
        bounds = materialise(bounds.where(fewer), "bounds")
        n_bounds, _, _ = _measured(bounds)
    return bounds.drop(_TIED), n_bounds


def _measured(bounds: DataFrame) -> tuple[int, int, int]:
    none = F.lit(0).cast("bigint")
    return tuple(
        bounds.agg(
            F.count(F.lit(1)), F.coalesce(F.max(_TIED), none), F.coalesce(F.sum(row_bytes(bounds)), none)
        ).first()
    )


def _bucket_bases(bucketed: DataFrame, cuts: Cuts | None) -> DataFrame:
    """For each bucket that is needed, how many rows lie in the buckets before it.

    One row of two numbers for ``rows_per_bucket`` rows of the table.
    """
    sizes = bucketed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.withColumn(_BASE, F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    if cuts is not None:
        bases = bases.where(cuts.any_in(F.col(_BASE), F.col(_BASE) + F.col("size")))
    return materialise(bases.select(_BUCKET, _BASE), "bases")


def _tuples_at(
    df: DataFrame, keys: Sequence[str], n_rows: int, cuts: Cuts, rows_per_bucket: int
) -> tuple[DataFrame, int]:
    """The key tuples at the cuts, each with its index, and about how large they are."""
    key_rows = df.select(*[col(k) for k in keys])
    ranked = rank(key_rows, keys, n_rows, rows_per_bucket, cuts)
    found = materialise(ranked.where(cuts.at(F.col(_IDX))), "starts")
    checked = found.agg(F.max(_TIED).alias("tied"), F.sum(row_bytes(found)).alias("bytes")).first()
    if checked["tied"]:
        raise TiedKeys(f"a cut would fall between copies of one key of {list(keys)}")
    return found.drop(_TIED), checked["bytes"] or 0


def _cut(
    df: DataFrame, keys: Sequence[str], n_rows: int, cuts: Cuts, rows_per_bucket: int
) -> tuple[DataFrame, tuple[str, ...], DataFrame, int]:
    """The rows, the columns that order them without ties, the tuples at the cuts, their size."""
    rows = _scanned_position(df)
    if rows is None:
        try:
            return df, tuple(keys), *_tuples_at(df, keys, n_rows, cuts, rows_per_bucket)
        except TiedKeys:
            rows = with_row_position(df)
    order = (*keys, *POSITION)
    return rows, order, *_tuples_at(rows, order, n_rows, cuts, rows_per_bucket)


@dataclass(frozen=True)
class Pages:
    """A table cut into pages: where they start, in which order, and how many."""

    rows: DataFrame
    order: tuple[str, ...]
    starts: DataFrame
    start_bytes: int
    n_rows: int
    chunk_size: int

    @property
    def n_pages(self) -> int:
        return page_count_of(self.n_rows, self.chunk_size)

    def can_be_looked_up(self, max_starts: int = MAX_PAGE_STARTS) -> bool:
        """Whether the page starts are few and small enough to travel to every task."""
        return self.n_pages - 1 <= max_starts and self.start_bytes <= MAX_BOUND_BYTES

    def every(self, n_ranges: int) -> list[tuple]:
        """Page starts that cut the table into at most ``n_ranges`` ranges of whole pages."""
        per_range = -(-self.n_pages // n_ranges) or 1
        page = F.call_function("div", F.col(_IDX), F.lit(self.chunk_size))
        chosen = self.starts.where(page % per_range == 0).orderBy(_IDX).collect()
        return [tuple(r[k] for k in self.order) for r in chosen]

    def tag(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the number of the page each belongs to."""
        n_starts = max(self.n_pages - 1, 0)
        return with_position(rows, self.order, self.starts, n_starts, CHUNK_ID).drop(*POSITION)

    def tagged(self) -> DataFrame:
        return self.tag(self.rows)


def page_table(
    df: DataFrame,
    keys: Sequence[str],
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    n_rows: int | None = None,
) -> Pages:
    """Find where the pages of ``df`` start."""
    cuts = Cuts(step=check_chunk_size(chunk_size))
    n_rows = df.count() if n_rows is None else n_rows
    rows, order, starts, size = _cut(df, keys, n_rows, cuts, rows_per_bucket)
    return Pages(rows, order, starts, size, n_rows, chunk_size)


def page_rows(
    df: DataFrame,
    keys: Sequence[str],
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    max_page_starts: int = MAX_PAGE_STARTS,
) -> DataFrame:
    """``df`` with ``_chunk_id``: the number of the page each row belongs to."""
    check_chunk_size(chunk_size)
    n_rows = df.count()
    if page_count_of(n_rows, chunk_size) - 1 <= max_page_starts:
        pages = page_table(df, keys, chunk_size, rows_per_bucket, n_rows)
        if pages.can_be_looked_up(max_page_starts):
            return pages.tagged()
    # More pages than can be looked up: number the whole rows instead.  Positions
    # leave no ties, so a task that runs again numbers them the same.
    rows = with_row_position(df)
    ranked = rank(rows, (*keys, *POSITION), n_rows, rows_per_bucket)
    page = F.call_function("div", F.col(_IDX), F.lit(chunk_size)).cast("int")
    return ranked.withColumn(CHUNK_ID, page).drop(_IDX, _TIED, *POSITION)


def page_rows_by_kept_keys(
    df: DataFrame, keys: Sequence[str], chunk_size: int = DEFAULT_CHUNK_SIZE
) -> DataFrame:
    """``page_rows`` for rows that are costly to read: the keys are read once and kept.

    Finding the pages reads the keys several times, so it reads the kept copy.
    Only where keys repeat across a cut is a copy of the whole rows needed.
    """
    kept = materialise(df.select(*[col(k) for k in keys]), "keys")
    pages = page_table_by_key(kept, keys, chunk_size)
    if pages is not None and pages.can_be_looked_up():
        return pages.tag(df)
    return page_rows(with_row_position(df), keys, chunk_size)


def page_table_by_key(
    key_rows: DataFrame, keys: Sequence[str], chunk_size: int = DEFAULT_CHUNK_SIZE
) -> Pages | None:
    """The pages of a table whose keys stand apart from its rows; None if a page would start between copies.

    Positions of the kept keys say nothing of the rows, so they are not used.
    """
    cuts, n_rows = Cuts(step=check_chunk_size(chunk_size)), key_rows.count()
    try:
        starts, size = _tuples_at(key_rows, keys, n_rows, cuts, ROWS_PER_BUCKET)
    except TiedKeys:
        return None
    return Pages(key_rows, tuple(keys), starts, size, n_rows, chunk_size)


def rows_between(
    df: DataFrame,
    keys: Sequence[str],
    start: int,
    stop: int,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    keep_position: bool = False,
) -> DataFrame:
    """The rows with index ``start`` up to, not including, ``stop`` in key order."""
    cuts = Cuts(listed=(start, stop))
    df, order, found, _ = _cut(df, keys, df.count(), cuts, rows_per_bucket)
    at = {r[_IDX]: [r[k] for k in order] for r in found.collect()}
    rows = df.where(_not_before(df, order, at[start])) if start in at else df.where(F.lit(False))
    if stop in at:
        rows = rows.where(~_not_before(df, order, at[stop]))
    return rows if keep_position else rows.drop(*POSITION)


def _not_before(df: DataFrame, order: Sequence[str], values: Sequence) -> Column:
    limit = F.struct(
        *[F.lit(v).cast(df.schema[k].dataType).alias(f"k{i}")
          for i, (k, v) in enumerate(zip(order, values, strict=True))]
    )
    return key_tuple(order) >= limit


def offset_fetch(
    df: DataFrame, keys: Sequence[str], offset: int, fetch: int, max_top_rows: int = MAX_TOP_ROWS
) -> DataFrame:
    """``fetch`` rows in key order after skipping ``offset``.

    Rows with equal keys follow their position in a Parquet scan; where there is
    none, a hash of their content, which leaves only rows in doubt that are the
    same.  A shallow page is a top-N; a deep one is found through the ranked
    keys, so that the skipped rows are never gathered in one place.
    """
    rows, order = _scanned_position(df), (*keys, *POSITION)
    if rows is None:
        hashed = [col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        rows, order = df.withColumn(_CONTENT, F.xxhash64(*hashed)), (*keys, _CONTENT)
    ordered = [col(k) for k in order]
    if offset + fetch <= max_top_rows:
        return rows.orderBy(*ordered).offset(offset).limit(fetch).drop(*POSITION, _CONTENT)
    found = rows_between(rows, order if _CONTENT in order else keys, offset, offset + fetch, keep_position=True)
    return found.orderBy(*ordered).drop(*POSITION, _CONTENT)


def union_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """Separately read pages as one table, matched by column name."""
    if not pages:
        raise ValueError("no pages to unite")
    combined = pages[0]
    for page in pages[1:]:
        combined = combined.unionByName(page)
    return combined


def tag_page(df: DataFrame, number: int) -> DataFrame:
    return df.withColumn(CHUNK_ID, F.lit(number))


def manifest(df: DataFrame, chunk_size: int) -> DataFrame:
    """Per page: its first row's offset and how many rows it holds."""
    return (
        df.groupBy(CHUNK_ID)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(
            CHUNK_ID,
            (F.col(CHUNK_ID).cast("bigint") * F.lit(chunk_size)).alias("row_offset"),
            "n_rows",
        )
    )


def chunk_plan(stats: DataFrame, chunk_size: int) -> DataFrame:
    """The pages each table should have, from its row count."""
    check_chunk_size(chunk_size)
    size = F.lit(chunk_size).cast("bigint")
    last = F.col("num_chunks") - 1
    return (
        stats.where(F.col("num_chunks") > 0)
        .select("table_name", "row_count", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("page"))
        .select(
            "table_name",
            F.col("page").cast("int").alias(CHUNK_ID),
            (F.col("page") * size).alias("row_offset"),
            F.least(size, F.col("row_count") - F.col("page") * size).alias("expected_rows"),
        )
    )


def check_manifest(plan: DataFrame, found: DataFrame) -> DataFrame:
    """Planned pages against the rows found, with an error text where they differ."""
    n_rows = F.coalesce(F.col("n_rows"), F.lit(0).cast("bigint"))
    text = F.concat(
        F.lit("expected "), F.col("expected_rows"), F.lit(" rows, found "), n_rows
    )
    return plan.join(
        found.select("table_name", CHUNK_ID, "n_rows"), ["table_name", CHUNK_ID], "left"
    ).select(
        "table_name",
        CHUNK_ID,
        "row_offset",
        "expected_rows",
        n_rows.alias("n_rows"),
        F.when(n_rows != F.col("expected_rows"), text).alias("error"),
    )
