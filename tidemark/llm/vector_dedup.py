"""Near-duplicate vectors by a forest of random-projection trees.

A tree cuts a group of vectors at the middle of a random projection, and what
lies near the cut goes to both sides.  Vectors are compared exactly within the
leaves; what is linked there in any tree is one component.  All links of a
vector lie within its component, so they are counted there, again exactly.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.ordering import col
from tidemark.functions.sizes import small_side
from tidemark.llm.components import components
from tidemark.llm.frames import hot_chunks
from tidemark.workspace import materialise

TREES = 8
SPILL = 0.05
LEAF = 256
LARGEST_LEAF = 1024
LEVELS = 6
SAMPLE = 4096
CHUNK = 512
FOREST_BYTES = 64 * 1024 * 1024


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True, initial=0)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of lists of equal length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _vectors(column: pa.Array, kind: str) -> np.ndarray:
    """A column of vectors of equal length, packed as numbers of ``kind``, in double precision."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    return raw.view(kind).astype(float).reshape(len(column), -1)


def _packed(values: np.ndarray, sizes: np.ndarray, valid: np.ndarray) -> pa.Array:
    """``values``, cut into packed vectors of ``sizes`` numbers, those that are not ``valid`` null."""
    ends = np.append(0, np.cumsum(sizes * values.itemsize)).astype(np.int32)
    mask = np.packbits(valid, bitorder="little").tobytes()
    return pa.Array.from_buffers(pa.binary(), len(sizes), [pa.py_buffer(b) for b in (mask, ends.tobytes(), values.tobytes())])


def _prepared(rows: DataFrame, kind: str) -> DataFrame:
    """``rows`` (``vec_id, l1, l2, x``) with ``x`` packed as ``v``, and ``size``; null if it can't be compared."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            longest = pc.max(pc.list_value_length(batch.column("x"))).as_py() or 1
            step = max(1, (1 << 24) // longest)  # offsets of a column have 32 bits
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = part.column("x")
                sizes = pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                values = x.flatten().to_numpy(zero_copy_only=False).astype(kind) + np.zeros(1, kind)  # nulls are NaN, both zeros one
                ends = np.append(0, np.cumsum(sizes))
                among = lambda told: np.diff(np.append(0, np.cumsum(told))[ends])
                good = (among(~np.isfinite(values)) == 0) & (among(values != 0) > 0)
                ids = [part.column(c) for c in ("vec_id", "l1", "l2")]
                yield pa.record_batch([*ids, pa.array(sizes), _packed(values, sizes, good)], ["vec_id", "l1", "l2", "size", "v"])

    return rows.mapInArrow(pack, "vec_id bigint, l1 bigint, l2 bigint, size bigint, v binary")


def _directions(tree: int, levels: int, dims: int) -> np.ndarray:
    """A random direction for each level of a tree; the first are the same whatever the number."""
    return np.random.default_rng((tree, dims)).standard_normal((levels, dims))


def _fit(place: np.ndarray, spill: float) -> np.ndarray:
    """The edges of each inner node, from the quantiles of the sampled vectors that reach it.

    ``place`` has a column for each level: where a vector lies along its direction.
    """
    cuts = np.zeros(((1 << place.shape[1]) - 1, 2))
    at = [np.arange(len(place))]
    for node in range(len(cuts)):
        rows = at[node]
        along = place[rows, (node + 1).bit_length() - 1]
        cuts[node] = np.quantile(along, (0.5 - spill, 0.5 + spill)) if len(rows) else 0.0
        at.append(rows[along <= cuts[node, 1]])
        at.append(rows[along >= cuts[node, 0]])
    return cuts


class _Forest:
    """The cuts of all trees: two numbers for each inner node, and where the nodes below a leaf stand once it is cut.

    Nodes of one level of a tree are cut along one direction, so a vector is
    projected once for a level, whatever the number of nodes.  Leaves are
    numbered; the first are the trees' roots, group by group.
    """

    def __init__(self, groups: np.ndarray, trees: Sequence[int]):
        self.groups, self.trees = np.sort(groups), trees
        self.depth = np.zeros(len(groups) * len(trees), np.int16)  # of each leaf
        self.below = np.full(len(self.depth), -1, np.int32)  # what cuts a leaf, if anything does
        self.first_edge, self.first_leaf, self.inner = (np.zeros(0, np.int64) for _ in range(3))
        self.edges = np.zeros((0, 2))

    def grow(self, cuts: dict[int, np.ndarray]) -> None:
        """Cut leaves; ``cuts`` has the edges of the nodes below each."""
        leaves = np.array(sorted(cuts), np.int64)
        inner = np.array([len(cuts[i]) for i in leaves.tolist()])
        levels = np.log2(inner + 1).round().astype(np.int64)
        self.below[leaves] = len(self.inner) + np.arange(len(leaves))
        self.first_edge = np.append(self.first_edge, len(self.edges) + np.cumsum(inner) - inner)
        self.first_leaf = np.append(self.first_leaf, len(self.depth) + np.cumsum(inner + 1) - inner - 1)
        self.inner = np.append(self.inner, inner)
        self.edges = np.concatenate([self.edges, *(cuts[i] for i in leaves.tolist())])
        self.depth = np.append(self.depth, np.repeat(self.depth[leaves] + levels, inner + 1).astype(np.int16))
        self.below = np.append(self.below, np.full((inner + 1).sum(), -1, np.int32))

    def leaves(self, grp: np.ndarray, unit: np.ndarray, jitter: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the leaves of the ``k``-th tree they reach: what lies between the edges of a cut goes to both sides."""
        place = unit @ _directions(self.trees[k], int(self.depth.max(initial=0)), unit.shape[1]).T + 1e-7 * jitter[:, None]
        rows, leaf, found = np.arange(len(grp)), np.searchsorted(self.groups, grp) * len(self.trees) + k, []
        while True:
            cut = self.below[leaf] >= 0
            found.append((rows[~cut], leaf[~cut]))
            rows, leaf = rows[cut], leaf[cut]
            if not len(rows):
                return tuple(np.concatenate(x) for x in zip(*found))
            which, node, level, reached = self.below[leaf], np.zeros(len(rows), np.int64), self.depth[leaf].astype(np.int64), []
            while len(rows):
                along, edges = place[rows, level], self.edges[self.first_edge[which] + node]
                left, right = along <= edges[:, 1], along >= edges[:, 0]
                rows, which, level = (np.concatenate((x[left], x[right])) for x in (rows, which, level + 1))
                node = np.concatenate((2 * node[left] + 1, 2 * node[right] + 2))
                out = node >= self.inner[which]
                reached.append((rows[out], (self.first_leaf[which] + node - self.inner[which])[out]))
                rows, which, level, node = (x[~out] for x in (rows, which, level, node))
            rows, leaf = (np.concatenate(x) for x in zip(*reached))


def _reached(
    rows: DataFrame,
    forest: _Forest,
    kind: str,
    tell: Callable[[pa.RecordBatch, np.ndarray, int, np.ndarray, np.ndarray], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """What ``tell`` makes of the leaves that each batch reaches in each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column("v")).to_numpy()
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                unit = _unit(_vectors(part.column("v"), kind))
                grp, jitter = part.column("grp").to_numpy(), part.column("jitter").to_numpy()
                for k, tree in enumerate(forest.trees):
                    yield from tell(part, unit, tree, *forest.leaves(grp, unit, jitter, k))

    return rows.mapInArrow(run, schema)


def _levels(n: np.ndarray) -> np.ndarray:
    """By how many levels nodes of ``n`` vectors are cut at once."""
    return np.clip(np.ceil(np.log2(n / LEAF)), 1, LEVELS).astype(np.int64)


def _grow(rows: DataFrame, forest: _Forest, sizes: dict[int, int], spill: float, kind: str) -> None:
    """Cut the leaves that hold ``sizes``, at quantiles of a sample of their vectors."""
    wanted = np.zeros(len(forest.depth), np.int64)
    chance = np.zeros(len(forest.depth))
    leaves, n = np.array(list(sizes)), np.array(list(sizes.values()))
    wanted[leaves] = _levels(n)
    chance[leaves] = (SAMPLE >> (LEVELS - wanted[leaves])) / n  # as many for each of the lowest nodes

    def draw(part, unit, tree, at, leaf):
        mine = part.column("draw").to_numpy()[at] < chance[leaf]
        at, leaf = at[mine], leaf[mine]
        first, levels = forest.depth[leaf].astype(np.int64), wanted[leaf]
        directions = _directions(tree, int((first + levels).max(initial=0)), unit.shape[1])
        jitter = part.column("jitter").to_numpy()
        for a, more in np.unique(np.stack((first, levels)), axis=1).T.tolist():
            own = np.flatnonzero((first == a) & (levels == more))
            place = unit[at[own]] @ directions[a : a + more].T + 1e-7 * jitter[at[own], None]
            every = np.full(len(own), more)
            yield pa.record_batch([pa.array(leaf[own]), _packed(place.ravel(), every, every > 0)], ["leaf", "place"])

    def fit(table: pa.Table) -> pa.RecordBatch:
        cuts = _fit(_vectors(_column(table, "place"), "<f8"), spill)
        return pa.record_batch([_column(table, "leaf")[:1], pa.array([cuts.tobytes()], pa.binary())], ["leaf", "cuts"])

    drawn = _reached(rows, forest, kind, draw, "leaf bigint, place binary")
    fitted = _by_group(drawn, "leaf", fit, "leaf bigint, cuts binary").collect()
    forest.grow({r["leaf"]: np.frombuffer(bytes(r["cuts"])).reshape(-1, 2) for r in fitted})


def _leaves(reps: DataFrame, trees: int, spill: float, largest_leaf: int, kind: str) -> DataFrame:
    """``leaf, rep, v`` for every vector, once or more for each tree; no leaf has over ``largest_leaf``.

    Nodes that are too large are cut by up to ``LEVELS`` levels at a time, at
    quantiles of a sample of about ``SAMPLE`` of their vectors, until none is.
    A group that is no larger than a leaf is the same leaf in every tree, and is compared once.
    Vectors are read again for each of these steps and go down all trees where
    they are; they move once, to the leaves.  The driver holds some 20 bytes for
    each node, of which there is one for some hundred vectors and tree, of as
    many trees at once as come to about ``FOREST_BYTES``, or of one.
    """
    groups = materialise(reps.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "vector-groups")
    large = groups.where(F.col("n") > largest_leaf).toArrow()
    if not large.num_rows:
        return reps.select(F.col("grp").alias("leaf"), "rep", "v")
    grp, n = (large.column(c).to_numpy() for c in ("grp", "n"))
    part = lambda seed: (F.pmod(F.xxhash64("rep", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    few = groups.where(F.col("n") > largest_leaf).select("grp")
    rows = materialise(
        reps.join(small_side(few), "grp", "left_semi").select("grp", "rep", "v", part(2).alias("jitter"), part(3).alias("draw")),
        "rows-of-trees",
    )

    def count(part, unit, tree, at, leaf):
        reached, n = np.unique(leaf, return_counts=True)
        yield pa.record_batch([pa.array(reached), pa.array(n)], ["leaf", "n"])

    def move(part, unit, tree, at, leaf):
        at = pa.array(at)
        yield pa.record_batch([pa.array(leaf), part.column("rep").take(at), part.column("v").take(at)], ["leaf", "rep", "v"])

    out = reps.join(small_side(few), "grp", "left_anti").select(F.col("grp").alias("leaf"), "rep", "v")
    at_once = max(1, FOREST_BYTES * LEAF // (64 * int(n.sum())))  # with what spills
    for first in range(0, trees, at_once):
        forest = _Forest(grp, range(first, min(trees, first + at_once)))
        open_leaves = dict(enumerate(np.repeat(n[np.argsort(grp)], len(forest.trees)).tolist()))
        while open_leaves:
            _grow(rows, forest, open_leaves, spill, kind)
            counted = _reached(rows, forest, kind, count, "leaf bigint, n bigint").groupBy("leaf").agg(F.sum("n").alias("n"))
            left = counted.where(F.col("n") > largest_leaf).toArrow()
            open_leaves = dict(zip(left.column("leaf").to_pylist(), left.column("n").to_pylist()))
        moved = _reached(rows, forest, kind, move, "leaf bigint, rep string, v binary")
        out = out.unionByName(moved.select(F.xxhash64(F.lit(first), "leaf").alias("leaf"), "rep", "v"))
    return out


def _by_group(df: DataFrame, key: str, compare: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``compare`` on the rows of each ``key``, one group at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            starts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, b in zip(starts, starts[1:]):
                if a == b:
                    continue
                if held and held[-1].column(key)[0].as_py() != keys[a]:
                    out = compare(pa.Table.from_batches(held).combine_chunks())
                    held = []
                    if out is not None:
                        yield out
                held.append(batch.slice(a, b - a))
        if held:
            out = compare(pa.Table.from_batches(held).combine_chunks())
            if out is not None:
                yield out

    return df.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)


def _column(table: pa.Table, name: str) -> pa.Array:
    return table.column(name).combine_chunks()


def _stars(threshold: float, kind: str) -> Callable[[pa.Table], pa.RecordBatch | None]:
    def compare(table: pa.Table) -> pa.RecordBatch | None:
        if table.num_rows < 2:
            return None
        vectors = _unit(_vectors(_column(table, "v"), kind))
        a, b = np.nonzero(np.triu(vectors @ vectors.T >= threshold, 1))
        if not len(a):
            return None
        head = np.arange(len(vectors))
        while True:
            least, before = np.minimum(head[a], head[b]), head.copy()
            np.minimum.at(head, a, least)
            np.minimum.at(head, b, least)
            head = head[head]
            if np.array_equal(before, head):
                break
        linked, rep = np.flatnonzero(head != np.arange(len(head))), _column(table, "rep")
        return pa.record_batch([rep.take(pa.array(linked)), rep.take(pa.array(head[linked]))], ["a", "b"])

    return compare


def _counts(threshold: float, kind: str) -> Callable[[pa.Table], pa.RecordBatch | None]:
    """Weighted numbers of links between the two chunks of a group, or within its only one."""

    def compare(table: pa.Table) -> pa.RecordBatch | None:
        side = _column(table, "side").to_numpy()
        vectors = _unit(_vectors(_column(table, "v"), kind))
        copies, rep = _column(table, "copies").to_numpy(), _column(table, "rep")
        first, second = np.flatnonzero(side <= 0), np.flatnonzero(side >= 0)  # side 0 is compared with itself
        links = vectors[first] @ vectors[second].T >= threshold
        n = np.zeros(len(side), np.int64)
        if len(first) and side[0] == 0:
            np.fill_diagonal(links, False)
            n = links @ copies
        else:
            n[first], n[second] = links @ copies[second], copies[first] @ links
        return pa.record_batch([rep, pa.array(n.astype(np.int64))], ["rep", "n"])

    return compare


def _with_core(large: DataFrame, threshold: float, kind: str) -> DataFrame:
    """Members of large components with ``core``: whether they lie within half the angle of their mean direction.

    Any two members of a core are linked, since their angles to the mean add up
    to no more than the threshold's.  A millionth of a radian is left for rounding.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            roots, place = np.unique(batch.column("root").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
            # a component's vectors have one length, but a batch may hold several components
            for i, root in enumerate(roots.tolist()):
                own = batch.column("v").take(pa.array(np.flatnonzero(place == i)))
                total = _unit(_vectors(own, kind)).sum(axis=0)
                yield pa.record_batch([pa.array([root]), pa.array([total], pa.list_(pa.float64()))], ["root", "s"])

    added = large.select("root", "v").mapInArrow(sums, "root string, s array<double>")
    by_axis = added.select("root", F.posexplode("s").alias("i", "s")).groupBy("root", "i").agg(F.sum("s").alias("s"))
    axes = F.array_sort(F.collect_list(F.struct("i", "s")))  # as many as the vectors have components
    centres = materialise(by_axis.groupBy("root").agg(F.transform(axes, lambda x: x["s"]).alias("centre")), "centres")
    least = math.cos(math.acos(threshold) / 2 - 1e-6)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = ["root", "rep", "v", "copies"]
        for batch in batches:
            core = np.zeros(batch.num_rows, bool)
            sizes = pc.binary_length(batch.column("v")).to_numpy()
            for size in np.unique(sizes):
                own = pa.array(np.flatnonzero(sizes == size))
                with np.errstate(invalid="ignore", divide="ignore"):  # a mean of zero has no direction, and no core
                    v = _unit(_vectors(batch.column("v").take(own), kind))
                    centre = _unit(_matrix(batch.column("centre").take(own)).astype(float))
                    core[own.to_numpy()] = (v * centre).sum(axis=1) >= least
            yield pa.record_batch([*(batch.column(c) for c in kept), pa.array(core)], [*kept, "core"])

    return large.join(small_side(centres), "root").mapInArrow(
        near, "root string, rep string, v binary, copies bigint, core boolean"
    )


def _link_counts(members: DataFrame, threshold: float, kind: str) -> DataFrame:
    """``rep, n``: the weighted number of other vectors linked to each of ``root, rep, v, copies, size``.

    Components of up to ``CHUNK`` vectors are compared whole.  In a larger one
    the members near its mean are known to be linked to each other and only
    counted.  The others are dealt into chunks and compared with each other and
    with chunks of the former, every pair of chunks by itself.  So a group of
    near copies, however large, costs its rows and not their square.
    """
    sized = materialise(members, "sized-members")
    whole = sized.where(F.col("size") <= CHUNK).drop("size").withColumn("core", F.lit(False))
    large = sized.where(F.col("size") > CHUNK).drop("size")
    flagged = whole if large.isEmpty() else whole.unionByName(materialise(_with_core(large, threshold, kind), "cores"))
    groups = flagged.groupBy("root").agg(
        hot_chunks(F.count_if("core"), CHUNK).alias("cores"),
        hot_chunks(F.count_if(~F.col("core")), CHUNK).alias("others"),
        F.coalesce(F.sum(F.when(F.col("core"), F.col("copies"))), F.lit(0)).alias("core_copies"),
    )
    groups = materialise(groups, "component-chunks")
    dealt = flagged.join(groups, "root")
    place = lambda n: F.pmod(F.xxhash64("rep", F.lit(7)), F.greatest(n, F.lit(1))).cast("int")
    mine = F.when(F.col("core"), place(F.col("cores"))).otherwise(F.col("cores") + place(F.col("others")))
    first = F.when(F.col("core"), F.col("cores")).otherwise(F.lit(0))
    last = F.col("cores") + F.col("others") - 1
    met = F.when(first <= last, F.sequence(first, last))
    pairs = dealt.select("root", "rep", "v", "copies", mine.alias("mine"), F.explode(met).alias("other")).select(
        F.xxhash64("root", F.least("mine", "other"), F.greatest("mine", "other")).alias("grp"),
        "rep", "v", "copies", F.signum(F.col("mine") - F.col("other")).cast("int").alias("side"),
    )
    compared = _by_group(pairs, "grp", _counts(threshold, kind), "rep string, n bigint")
    known = dealt.where("core").select("rep", (F.col("core_copies") - F.col("copies")).alias("n"))
    return compared.unionByName(known).groupBy("rep").agg(F.sum("n").alias("n"))


def near_duplicate_vectors(
    df: DataFrame,
    threshold: float = 0.93,
    trees: int = TREES,
    spill: float = SPILL,
    largest_leaf: int | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``df``.

    Vectors of one label and length whose cosine, in double precision, is at
    least ``threshold`` are linked.  ``n_links`` counts the other rows linked to
    a row, ``component_id`` is the least id that links lead to, and the row
    that has it is kept.  Links are looked for in the leaves of ``trees`` trees,
    which have at most ``largest_leaf`` vectors (``LARGEST_LEAF`` if not given);
    a share ``spill`` of a node's vectors on either side of its cut goes to both.  Vectors that are null, zero or hold null or non-finite
    components, and those without a label, link with nothing.  Equal vectors
    are compared once and count as often as they come.  Rows with a null id
    link like any other and are not kept if their component has an id; a
    component without ids has a null id and none of its rows are kept; an
    empty table gives an empty result; other columns are not read.
    """
    given = df.select(col(vector_col).alias("x"))
    single = isinstance(given.schema["x"].dataType.elementType, T.FloatType)
    kind = "<f4" if single else "<f8"  # packed numbers; what is computed from them is in double precision
    x = col(vector_col) if single else F.transform(col(vector_col), lambda v: v.cast("double"))
    label = col(label_col)
    told = (F.when(label.isNotNull(), F.xxhash64(label)).alias("l1"), F.xxhash64(F.lit(1), label).alias("l2"))
    rows = _prepared(df.select(col(id_col).cast("bigint").alias("vec_id"), *told, x.alias("x")), kind)
    hashes = (F.xxhash64("l1", "v"), F.xxhash64(F.lit(1), "v", "l2"))
    name = F.concat(*[F.lower(F.lpad(F.hex(h), 16, "0")) for h in hashes])
    usable = F.col("l1").isNotNull() & F.col("v").isNotNull()
    rows = materialise(
        rows.select("vec_id", F.when(usable, name).alias("rep"), F.xxhash64("l1", "l2", "size").alias("grp"), "v"), "packed-vectors"
    )
    reps = materialise(
        rows.where("rep is not null")
        .groupBy("rep", "grp", "v")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least")),
        "distinct-vectors",
    )
    leaves = _leaves(reps.select("grp", "rep", "v"), trees, spill, largest_leaf or LARGEST_LEAF, kind)
    links = _by_group(leaves, "leaf", _stars(threshold, kind), "a string, b string")
    roots = components(materialise(links.distinct(), "vector-links"))
    joined = materialise(
        reps.join(roots, reps["rep"] == roots["node"], "left").select(
            "rep", F.coalesce("root", "rep").alias("root"), "least", "copies", "v"
        ),
        "rooted-vectors",
    )
    # tables of their own, so that the rows of a very large component can be split over tasks
    heads = joined.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("size"))
    heads = materialise(heads, "component-heads")
    alone = joined.join(heads, "root").select("rep", "root", "component_id", "copies", "size", "v")
    counts = _link_counts(alone.where("size > 1").select("root", "rep", "v", "copies", "size"), threshold, kind)
    told = alone.select("rep", "component_id", "copies").join(counts, "rep", "left").select(
        "rep", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    out = rows.select("vec_id", "rep").join(told, "rep", "left")
    of = F.when(F.col("rep").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        of.alias("component_id"),
        F.coalesce(F.col("vec_id") == of, F.lit(False)).alias("kept"),
    )
