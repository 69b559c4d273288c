"""Whitening of embeddings by eigenvectors refined in mixed precision.

The covariance of the distinct vectors is added up over the cluster: tasks
centre their vectors by the exact mean and multiply, and only matrices of the
size of a vector squared leave a task.  Its eigenvectors are found in float32
and then corrected in float64 by matrix products alone (Ogita and Aishima):
each step about squares the error.  Where eigenvalues lie too close together
for that correction to tell their vectors apart, the cluster's subspace is kept
and a small problem within it, shifted by the cluster's mean eigenvalue, is
solved in its place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ordering import col
from tidemark.workspace import materialise

# Steps of refinement at most; three or four take float32 to float64.
MAX_STEPS = 20
# A matrix of this many columns has 128 MB.
MAX_DIMENSION = 4096

_MOMENTS = "i int, rows bigint, mean double, products array<double>"


def clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """The places of values that lie within ``gap`` of a neighbour, for each run of two or more."""
    order = np.argsort(values)
    cut = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [run for run in np.split(order, cut) if len(run) > 1]


def refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of the symmetric matrix ``a`` in float64, from approximate vectors ``x``."""
    x = x.astype(np.float64)
    d, scale = len(a), np.linalg.norm(a, 2)
    unit, best, idle = np.finfo(np.float64).eps, np.inf, 0
    for _ in range(MAX_STEPS):
        r = np.eye(d) - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        near = 2 * (np.linalg.norm(s - np.diag(values), 2) + scale * np.linalg.norm(r, 2))
        idle = idle + 1 if near > best / 2 else 0
        best, near = min(best, near), max(near, 64 * d * unit * scale)  # closer values differ by rounding alone
        between = values[None, :] - values[:, None]
        apart = np.abs(between) > near
        # the turn is skew whatever its rounding, so vectors that lie close stay orthogonal
        turn = np.where(apart, (s + (values[None, :] + values[:, None]) / 2 * r) / np.where(apart, between, 1), 0)
        e = r / 2 + turn
        x = x + x @ e
        for run in clusters(values, near):  # no correction told these apart
            basis = np.linalg.qr(x[:, run])[0]
            shift = values[run].mean()
            within = basis.T @ (a @ basis - shift * basis)
            x[:, run] = basis @ np.linalg.eigh((within + within.T) / 2)[1]
        if np.abs(e).max() <= 8 * unit or idle == 2:
            break
    x = x @ (1.5 * np.eye(d) - 0.5 * (x.T @ x))  # what close vectors have lost of being orthogonal
    return np.einsum("ij,ij->j", x, a @ x), x / np.linalg.norm(x, axis=0)


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns; the largest entry of each is positive)."""
    d, largest = len(a), np.abs(a).max(initial=0.0)
    if largest == 0:
        return np.zeros(d), np.eye(d)
    scaled = a / largest  # float32 has no room for all that float64 can hold
    values, vectors = refine(scaled, np.linalg.eigh(scaled.astype(np.float32))[1])
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order] * largest, vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(d)])
    return values, vectors * signs


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def moments(vectors: DataFrame, column: str, dimension: int, centre: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, mean (less ``centre``) and covariance of array columns of equal length.

    Each task takes its own mean off before it multiplies; the tasks' matrices
    are added up row by row in Spark together with the products of their means,
    and one matrix comes to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, m2 = 0, np.zeros(dimension), np.zeros((dimension, dimension))
        for batch in batches:
            x = _matrix(batch.column(0), dimension) - centre
            if not len(x):
                continue
            own = x.mean(0)
            y = x - own
            off = own - mean
            total = n + len(x)
            m2 += y.T @ y + np.outer(off, off) * (n * len(x) / total)
            mean = mean + off * (len(x) / total)
            n = total
        if n:
            yield pa.record_batch(
                [
                    pa.array(np.arange(dimension, dtype=np.int32)),
                    pa.array(np.full(dimension, n)),
                    pa.array(mean),
                    pa.array(list(m2 + n * np.outer(mean, mean)), pa.list_(pa.float64())),
                ],
                ["i", "rows", "mean", "products"],
            )

    # The products are about ``centre``, which lies so near the mean that taking the rest off loses nothing.
    parts = vectors.select(column).mapInArrow(run, _MOMENTS)
    cells = parts.select("i", "rows", "mean", F.posexplode("products").alias("j", "product"))
    sums = cells.groupBy("i", "j").agg(
        F.sum("rows").alias("n"), F.sum(F.col("rows") * F.col("mean")).alias("total"), F.sum("product").alias("product")
    )
    rows = sums.groupBy("i").agg(
        F.max("n").alias("n"), F.max("total").alias("total"),
        F.transform(F.array_sort(F.collect_list(F.struct("j", "product"))), lambda c: c["product"]).alias("products"),
    )
    found = sorted(rows.collect(), key=lambda r: r["i"])  # one row per dimension
    if not found:
        return 0, np.zeros(dimension), np.zeros((dimension, dimension))
    n = found[0]["n"]
    mean = np.array([r["total"] for r in found]) / n
    v = np.array([r["products"] for r in found]) / n - np.outer(mean, mean)
    return n, mean, (v + v.T) / 2


@dataclass
class Whitening:
    """What was fitted: ``n`` distinct vectors with sums ``s``, eigenvalues and eigenvectors of their covariance."""

    rows: DataFrame  # vec_id, x
    distinct: DataFrame  # x
    n: int
    s: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def dimension(self) -> int:
        return len(self.s)

    def rank(self, components: int) -> int:
        """How many of the first components have variance beyond rounding."""
        least = self.dimension * np.finfo(np.float64).eps * self.trace
        return int((self.values[:components] > least).sum())

    def _projection(self, components: int) -> tuple[np.ndarray, np.ndarray]:
        k = self.rank(components)
        mean = np.array([float(x) / self.n for x in self.s])
        return mean, self.vectors[:, :k] / np.sqrt(self.values[:k])

    def identity_error(self, components: int) -> float | None:
        """The largest entry of the covariance of the whitened distinct vectors less the identity."""
        k = self.rank(components)
        if not k:
            return None
        mean, axes = self._projection(components)
        d = self.dimension

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                w = (_matrix(batch.column(0), d) - mean) @ axes
                yield pa.record_batch([pa.array(list(w), pa.list_(pa.float64()))], ["w"])

        _, _, v = moments(self.distinct.mapInArrow(run, "w array<double>"), "w", k, np.zeros(k))
        return float(np.abs(v - np.eye(k)).max())

    def whitened(self, components: int = 4) -> DataFrame:
        """``vec_id, component, n, deviation, whitened, explained, identity_error`` per row and component.

        ``deviation`` is the exact sum of squares of ``n * x - s``, a decimal of
        38 digits (null beyond that).  Components without variance have a null ``whitened``;
        ``explained`` is null if no vector differs from another.
        """
        d, n, s, k = self.dimension, self.n, self.s, self.rank(components)
        given = min(components, d)
        if not n or not given:
            return self.rows.sparkSession.createDataFrame([], _RESULT)
        mean, axes = self._projection(components)
        explained = [float(e / self.trace) if self.trace else None for e in self.values[:given]]
        error = self.identity_error(components)
        squares = sum(x * x for x in s)
        # as two halves, so that no product with an entry leaves 64 bits
        low, high = np.array([x & 0xFFFFFF for x in s]), np.array([x >> 24 for x in s])
        deviations = pa.decimal128(38, 0)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column("x"), d)
                if not len(x):
                    continue
                own = np.einsum("ij,ij->i", x, x).tolist()
                cross = [(int(b) << 24) + int(a) for a, b in zip(x @ low, x @ high)]
                exact = [n * n * q - 2 * n * p + squares for q, p in zip(own, cross)]
                deviation = pa.array([Decimal(v) if v < 10**38 else None for v in exact], deviations)
                w = (x - mean) @ axes
                for c in range(given):
                    rows = len(x)
                    yield pa.record_batch(
                        [
                            batch.column("vec_id"),
                            pa.array(np.full(rows, c + 1, np.int32)),
                            pa.array(np.full(rows, n, np.int64)),
                            deviation,
                            pa.array(w[:, c]) if c < k else pa.nulls(rows, pa.float64()),
                            pa.array([explained[c]] * rows, pa.float64()),
                            pa.array([error] * rows, pa.float64()),
                        ],
                        [f.split()[0] for f in _RESULT.split(", ")],
                    )

        return self.rows.mapInArrow(run, _RESULT)


_RESULT = (
    "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vector.isNotNull() & finite


def fit(
    df: DataFrame, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", bound: int = 1 << 24
) -> Whitening:
    """Fit to every distinct vector of ``floor(scale * entry)``, each counted once.

    Vectors that are null or hold null or non-finite entries take no part, nor
    do vectors of another length than most have (of equally common lengths the
    largest), nor empty ones.  Entries whose scaled value reaches ``bound``
    raise an error, for sums and squares of the others are exact.  Null ids stay
    null; repeated rows are whitened each, but fitted once; an empty table
    gives an empty result; columns of other names are not read.

    The distinct vectors are found by one shuffle of vectors folded before it,
    written to the shared folder and read three times.  The driver holds one
    matrix of the squared dimension (up to ``MAX_DIMENSION``), whatever the
    number of vectors.
    """
    vector = col(vector_col).cast("array<double>")
    usable = df.select(col(id_col).cast("bigint").alias("vec_id"), vector.alias("v")).where(_usable(F.col("v")))
    in_range = F.forall("v", lambda c: F.abs(c * F.lit(scale)) < F.lit(float(bound)))
    checked = F.when(in_range, F.col("v")).otherwise(F.raise_error(F.lit("an entry is too large to whiten exactly")).cast("array<double>"))
    # adding 0 turns -0.0, which floor() of a double may give elsewhere, into 0; a bigint has no -0
    whole = usable.select("vec_id", F.transform(checked, lambda c: F.floor(c * F.lit(scale)).cast("bigint")).alias("x"))
    lengths = whole.where(F.size("x") > 0).groupBy(F.size("x").alias("d")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = common[0]["d"] if common else 0
    if d > MAX_DIMENSION:
        raise ValueError(f"vectors of {d} entries are beyond {MAX_DIMENSION}")
    rows = whole.where(F.size("x") == d) if d else whole.where(F.lit(False))
    distinct = materialise(rows.select("x").distinct(), "distinct-vectors")
    if not d:
        return Whitening(rows, distinct, 0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    entries = distinct.select(F.posexplode("x").alias("i", "c"))
    sums = entries.groupBy("i").agg(F.sum(F.col("c").cast("decimal(20,0)")).alias("s"), F.count(F.lit(1)).alias("n")).collect()
    s = [int(r["s"]) for r in sorted(sums, key=lambda r: r["i"])]
    n = sums[0]["n"]
    _, _, v = moments(distinct, "x", d, np.array([float(x) / n for x in s]))
    values, vectors = eigen(v)
    return Whitening(rows, distinct, n, s, values, vectors, float(np.trace(v)))


def digest(whitened: DataFrame) -> DataFrame:
    """The rows of ``Whitening.whitened`` with ``deviation`` as a whole number of 64 bits, null beyond that."""
    return whitened.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))
