"""A Merkle manifest of a table: one root, and a proof for each row.

Rows are leaves, ordered within their group; every run of three nodes makes one
node above it until one is left, and the groups' roots make a tree of their own.

Leaves are numbered over the whole table and dealt in chunks of consecutive
ones, whatever their groups.  A chunk works out the nodes that lie in it alone
and puts out only those whose parents reach beyond it; the parents are joined
from those.  For the proofs each chunk works out, from numbers alone, the least
set of nodes that its leaves need and can't derive (an octopus multiproof),
fetches each of them once, derives every shared node above its leaves and
expands the proofs of its rows where they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ordering import col
from tidemark.llm.frames import with_base
from tidemark.workspace import materialise

ARITY = 3
# Consecutive leaves that one task handles together.
CHUNK = 4096
# Levels that one task joins together above the chunks: 3**14 leaves have some 40,000 nodes there.
CROWN_LEVELS = 14
# Copies of a node that many chunks ask for.
SALTS = 64
# Chunks that one row of a group's extent is spread to at a time.
SPREAD = 4096
BATCH_ROWS = 500

_TOP = -1  # the tree of the groups' roots
_NODES = "tree bigint, level int, idx bigint, n bigint, top boolean, hash string"


def digest_of(parts: Iterable[str]) -> str:
    """Lowercase hex SHA-256 of texts, one after the other."""
    return sha256("".join(parts).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def leaf_hash(*fields: Column) -> Column:
    """The digest of fields in order: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""

    def written(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(written, fields)).cast("binary"), 256)


def climb(hashes: list[str], lo: int, n: int) -> Iterator[tuple[int, int, str]]:
    """``level, idx, hash`` of what consecutive nodes from ``lo`` on give, of those whose parents they don't give."""
    level = 0
    while n > 1:
        hi, above = lo + len(hashes), -(-n // ARITY)
        first, last = -(-lo // ARITY), above if lo + len(hashes) == n else (lo + len(hashes)) // ARITY
        if first >= last:
            break
        left, right = first * ARITY - lo, min(last * ARITY, hi) - lo
        yield from ((level, lo + k, hashes[k]) for k in (*range(left), *range(right, len(hashes))))
        hashes = [digest_of(hashes[k : min(k + ARITY, right)]) for k in range(left, right, ARITY)]
        lo, n, level = first, above, level + 1
    yield from ((level, lo + k, h) for k, h in enumerate(hashes))


def missing(lo: int, hi: int, n: int) -> Iterator[tuple[int, int]]:
    """``level, idx`` of the least set of nodes that, with leaves ``lo`` to ``hi``, gives all above them."""
    level = 0
    while n > 1:
        yield from ((level, k) for k in range(lo // ARITY * ARITY, lo))
        lo, above = lo // ARITY, -(-hi // ARITY)
        yield from ((level, k) for k in range(hi, min(n, above * ARITY)))
        hi, n, level = above, -(-n // ARITY), level + 1


def expand(hashes: list[str], lo: int, n: int, fetched: dict[tuple[int, int], str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and for each of consecutive leaves its siblings left and right, level by level."""
    rows, level = [], 0
    while n > 1:
        hi = lo + len(hashes)
        start, end = lo // ARITY * ARITY, min(n, -(-hi // ARITY) * ARITY)
        whole = [fetched[level, k] for k in range(start, lo)] + hashes + [fetched[level, k] for k in range(hi, end)]
        rows.append((start, lo, hi, whole))
        hashes = [digest_of(whole[k : k + ARITY]) for k in range(0, len(whole), ARITY)]
        lo, n, level = start // ARITY, -(-n // ARITY), level + 1
    paths: list[list[tuple[str, str]]] = [[]]
    for start, lo, hi, whole in reversed(rows):  # from the root down, so that all below a node share its path
        below = []
        for k in range(lo - start, hi - start):
            run = k - k % ARITY
            step = ("".join(whole[run:k]), "".join(whole[k + 1 : run + ARITY]))
            below.append([step, *paths[k // ARITY]])
        paths = below
    return hashes[0], paths


def _numbered(rows: DataFrame, keys: list[str], purpose: str) -> DataFrame:
    """``rows`` with ``pos``, their place in the order of ``keys``: a range shuffle and two prefix sums."""
    at = F.monotonically_increasing_id()
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = ordered.select(
        *rows.columns, F.shiftright(at, 33).alias("part"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("local"), F.lit(1).alias("one")
    )
    table = with_base(materialise(placed, purpose), "part", "one")
    return table.select(*rows.columns, (F.col("base") + F.col("local")).alias("pos"))


def _columns(batches: Iterator[pa.RecordBatch], names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in names.split()))


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_NODE_SCHEMA = pa.schema(
    [("tree", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("n", pa.int64()), ("top", pa.bool_()), ("hash", pa.string())]
)


@dataclass
class _Chunk:
    """The trees that meet in a run of consecutive leaves, and the leaves."""

    chunk: int
    extents: list[tuple[int, int, int]]  # tree, position of its first leaf, number of its leaves
    fetched: dict[tuple[int, int, int], str]
    leaves: list[tuple]  # pos, hash, ...

    def segments(self) -> Iterator[tuple[int, int, int, list[tuple]]]:
        """``tree, lo, n, leaves`` for each tree."""
        at = 0
        for tree, start, n in self.extents:
            lo = self.leaves[at][0] - start
            size = min(n - lo, len(self.leaves) - at)
            yield tree, lo, n, self.leaves[at : at + size]
            at += size


def _chunks(rows: Iterator[tuple]) -> Iterator[_Chunk]:
    """Rows of ``_dealt``, put together by chunk; a chunk holds at most ``CHUNK`` leaves."""
    held: _Chunk | None = None
    for chunk, kind, a, b, c, d, *rest in rows:
        if held is None or held.chunk != chunk:
            if held is not None:
                yield held
            held = _Chunk(chunk, [], {}, [])
        if kind == 0:
            held.extents.append((a, b, c))
        elif kind == 1:
            held.fetched[a, b, c] = d
        else:
            held.leaves.append((a, d, *rest))
    if held is not None:
        yield held


_DEALT = "chunk kind a b c d doc_id carry"


def _dealt(*parts: DataFrame) -> DataFrame:
    """Extents, fetched nodes and leaves of each chunk, in that order, in one task each."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    names = _DEALT.split()
    types = dict(zip(names, ("bigint", "int", "bigint", "bigint", "bigint", "string", "bigint", "string")))
    absent = [F.lit(None).cast(types[c]).alias(c) for c in names if c not in rows.columns]
    rows = rows.select(*[c for c in names if c in rows.columns], *absent).select(*names)
    return rows.repartition("chunk").sortWithinPartitions("chunk", "kind", "a", "b", "c")


def _extent_rows(trees: DataFrame) -> DataFrame:
    """One row for each chunk that a tree has leaves in."""
    first, last = F.expr(f"start div {CHUNK}"), F.expr(f"(start + n - 1) div {CHUNK}")
    wide = trees.select("*", F.explode(F.sequence(F.expr(f"start div {CHUNK * SPREAD}"), F.expr(f"(start + n - 1) div {CHUNK * SPREAD}"))).alias("far"))
    chunk = F.explode(F.sequence(F.greatest(first, F.col("far") * SPREAD), F.least(last, F.col("far") * SPREAD + SPREAD - 1)))
    return wide.select(
        chunk.alias("chunk"), F.lit(0).alias("kind"),
        F.col("tree").alias("a"), F.col("start").alias("b"), F.col("n").alias("c"),
    )


def _leaf_rows(leaves: DataFrame, *more: str, chunk: str | None = None) -> DataFrame:
    return leaves.select(
        F.expr(chunk or f"pos div {CHUNK}").alias("chunk"), F.lit(2).alias("kind"), F.col("pos").alias("a"),
        F.lit(0).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("c"), F.col("hash").alias("d"), *more,
    )


def _nodes(dealt: DataFrame, tallest: int) -> DataFrame:
    """All nodes that more than one chunk takes part in, and their children; with them the roots."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for chunk in _chunks(_columns(batches, _DEALT)):
                for tree, lo, n, held in chunk.segments():
                    top = height(n)
                    for level, idx, found in climb([x[1] for x in held], lo, n):
                        yield tree, level, idx, n, level == top, found

        return _batched(rows(), _NODE_SCHEMA, 20_000)

    found = materialise(dealt.mapInArrow(local, _NODES), "merkle-nodes")
    for base in range(0, tallest, CROWN_LEVELS):
        found = found.unionByName(materialise(_joined(found, base, base + CROWN_LEVELS), "merkle-nodes"))
    return found


def _joined(nodes: DataFrame, base: int, to: int) -> DataFrame:
    """The nodes above those from level ``base`` on, up to level ``to``; what lies below one of that level meets in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(tree: int, n: int, levels: dict[int, list[tuple[int, str]]]) -> Iterator[tuple]:
            top = height(n)
            for level in range(min(levels), min(to, top)):
                row = sorted(levels.pop(level, ()))
                parents: dict[int, list[str]] = {}
                for idx, found in row:
                    parents.setdefault(idx // ARITY, []).append(found)
                made = [(idx, digest_of(children)) for idx, children in parents.items()]
                levels.setdefault(level + 1, []).extend(made)
                yield from ((tree, level + 1, idx, n, level + 1 == top, found) for idx, found in made)

        def rows() -> Iterator[tuple]:
            key, n, levels = None, 0, {}
            for tree, above, level, idx, size, found in _columns(batches, "tree block level idx n hash"):
                if key != (tree, above):
                    if key is not None:
                        yield from block(key[0], n, levels)
                    key, n, levels = (tree, above), size, {}
                levels.setdefault(level, []).append((idx, found))
            if key is not None:
                yield from block(key[0], n, levels)

        return _batched(rows(), _NODE_SCHEMA, 20_000)

    leaf = F.col("idx") * F.expr(f"CAST(pow({ARITY}, level) AS BIGINT)")
    blocks = nodes.where(~F.col("top") & F.col("level").between(base, to - 1)).withColumn("block", F.floor(leaf / F.lit(ARITY**to)).cast("bigint"))
    return blocks.repartition("tree", "block").sortWithinPartitions("tree", "block", "level", "idx").mapInArrow(run, _NODES)


def _wanted(trees: DataFrame, n_trees: int) -> DataFrame:
    """``chunk, tree, level, idx`` of the nodes that each chunk has to fetch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("chunk", pa.int64()), ("tree", pa.int64()), ("level", pa.int32()), ("idx", pa.int64())])

        def rows() -> Iterator[tuple]:
            for chunk in _chunks(_columns(batches, _DEALT)):
                lo, hi = chunk.chunk * CHUNK, (chunk.chunk + 1) * CHUNK
                for tree, start, n in chunk.extents:
                    for level, idx in missing(max(lo, start) - start, min(hi, start + n) - start, n):
                        yield chunk.chunk, tree, level, idx
                for level, idx in missing(chunk.extents[0][0], chunk.extents[-1][0] + 1, n_trees):
                    yield chunk.chunk, _TOP, level, idx

        return _batched(rows(), schema, 20_000)

    return _dealt(_extent_rows(trees)).mapInArrow(run, "chunk bigint, tree bigint, level int, idx bigint")


def _fetched(wanted: DataFrame, nodes: DataFrame) -> DataFrame:
    """The wanted nodes, one row for each chunk that asked.

    A node at level l is asked for by the chunks below its parent only, but for
    high ones and those of the tree of trees these can be many: they are kept in
    ``SALTS`` copies.
    """
    often = (F.col("tree") == _TOP) | (F.col("level") >= CROWN_LEVELS)
    salts = F.when(often, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copies = nodes.select("tree", "level", "idx", "hash", F.explode(salts).alias("salt"))
    asked = wanted.withColumn("salt", F.when(often, F.pmod("chunk", F.lit(SALTS))).otherwise(F.lit(0)).cast("int"))
    return asked.join(copies, ["tree", "level", "idx", "salt"]).select(
        "chunk", F.lit(1).alias("kind"),
        F.col("tree").alias("a"), F.col("level").cast("bigint").alias("b"), F.col("idx").alias("c"), F.col("hash").alias("d"),
    )


_PROOFS = "doc_id bigint, leaf string, subroot string, root string, steps array<struct<left:string,right:string>>, carry string"
_STEPS = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


@dataclass
class Manifest:
    """The numbered leaves, the extents of the trees and the shared nodes."""

    leaves: DataFrame  # doc_id, source, hash, carry, pos
    trees: DataFrame  # source, tree, start, n
    nodes: DataFrame
    n_trees: int
    root: str | None

    def roots(self) -> DataFrame:
        """``source, n, subroot`` of each group."""
        tops = self.nodes.where(F.col("top") & (F.col("tree") != _TOP)).select("tree", F.col("hash").alias("subroot"))
        return self.trees.join(tops, "tree").select("source", "n", "subroot")

    def proofs(self) -> DataFrame:
        """``doc_id, leaf, subroot, root, steps, carry`` per row.

        A step is what stands left and right of the node in its run, from the
        leaf to the root; a run of one has nothing on either side.
        """
        n_trees, root = self.n_trees, self.root
        schema = pa.schema(
            [("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("steps", _STEPS), ("carry", pa.string())]
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def rows() -> Iterator[tuple]:
                for chunk in _chunks(_columns(batches, _DEALT)):
                    trees: dict[int, dict] = {}
                    for (tree, level, idx), found in chunk.fetched.items():
                        trees.setdefault(tree, {})[level, idx] = found
                    own = []
                    for tree, lo, n, leaves in chunk.segments():
                        own.append((*expand([x[1] for x in leaves], lo, n, trees.get(tree, {})), leaves))
                    top, ways = expand([s for s, _, _ in own], chunk.extents[0][0], n_trees, trees.get(_TOP, {}))
                    if top != root:
                        raise ValueError(f"chunk {chunk.chunk} derives another root; its input changed while it was read")
                    for (subroot, paths, leaves), way in zip(own, ways):
                        for (_, leaf, doc_id, carry), path in zip(leaves, paths):
                            steps = [{"left": a, "right": b} for a, b in (*path, *way)]
                            yield doc_id, leaf, subroot, root, steps, carry

            return _batched(rows(), schema, BATCH_ROWS)

        extents = _extent_rows(self.trees)
        dealt = _dealt(extents, _fetched(_wanted(self.trees, n_trees), self.nodes), _leaf_rows(self.leaves, "doc_id", "carry"))
        return dealt.mapInArrow(run, _PROOFS)


def build(
    df: DataFrame,
    carry: Column | None = None,
    id_col: str = "doc_id",
    group_col: str = "source",
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
) -> Manifest:
    """The manifest of every row of ``df``; ``carry`` is any text that comes back beside a row's proof.

    A leaf is ``leaf_hash`` of ``fields``.  Leaves of a group ascend by id
    (nulls first; rows with one id by their leaf, so repeated rows each have a
    place and a proof), groups by name, bytewise (null first).  Null and empty
    fields differ in their leaves; texts of any length are hashed where they are
    read and go no further; an empty table has no root and no proofs; other
    columns, whatever their names, are not read.

    Digests are shuffled, never texts: once by range to be numbered, and once by
    chunk for the nodes and for the proofs each.  Chunks cut groups anywhere, so
    one that holds most rows is spread like any other.  Only counts and the root
    come to the driver.
    """
    rows = df.select(
        col(id_col).cast("bigint").alias("doc_id"),
        col(group_col).cast("string").alias("source"),
        leaf_hash(*map(col, fields)).alias("hash"),
        (F.lit(None) if carry is None else carry).cast("string").alias("carry"),
        F.xxhash64(F.monotonically_increasing_id()).alias("tie"),  # deals equal rows over tasks
    )
    keys = ["source", "doc_id", "hash", "tie"]
    leaves = _numbered(materialise(rows, "merkle-leaves"), keys, "merkle-numbered").drop("tie")
    extents = leaves.groupBy("source").agg(F.min("pos").alias("start"), F.count(F.lit(1)).alias("n"))
    trees = materialise(_numbered(extents, ["start"], "merkle-groups").withColumnRenamed("pos", "tree"), "merkle-trees")
    found = trees.agg(F.count(F.lit(1)).alias("trees"), F.max("n").alias("n")).first()
    n_trees, root = found["trees"], None
    nodes = _nodes(_dealt(_extent_rows(trees), _leaf_rows(leaves)), height(found["n"] or 0))
    if n_trees:
        tops = nodes.where("top").select("tree", "hash").join(trees.select("tree", "start", "n"), "tree")
        subroots = tops.withColumnRenamed("tree", "pos")
        # the groups that begin in a chunk; the one that goes on beyond it apart, for others have it without them
        chunk = f"2 * (start div {CHUNK}) + int((start + n - 1) div {CHUNK} > start div {CHUNK})"
        extents = subroots.select(F.expr(chunk).alias("chunk")).distinct().select(
            "chunk", F.lit(0).alias("kind"), F.lit(_TOP).cast("bigint").alias("a"),
            F.lit(0).cast("bigint").alias("b"), F.lit(n_trees).cast("bigint").alias("c"),
        )
        over = _nodes(_dealt(extents, _leaf_rows(subroots, chunk=chunk)), height(n_trees))
        nodes, root = nodes.unionByName(over), over.where("top").first()["hash"]
    return Manifest(leaves, trees, nodes, n_trees, root)


def proof_hash(steps: Column) -> Column:
    """The digest of a proof's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]).cast("binary"), 256))


def tampered(df: DataFrame) -> Column:
    """The leaves of ``documents`` after the line ends of some texts were lost: where 2 divides the crc32 of the id."""
    lost = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(F.coalesce(lost, F.lit(False)), F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)


def checked(proofs: DataFrame) -> DataFrame:
    """Each row's proof folded from the leaf that was carried with it."""
    rows = proofs.select(
        "doc_id", "leaf", "subroot", "root",
        proof_hash(F.col("steps")).alias("proof_sha256"),
        folded(F.col("carry"), F.col("steps")).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
