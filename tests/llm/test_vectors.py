"""Top-k search and vector groups against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk_search, vector_dedup

INF, NAN = float("inf"), float("nan")


@pytest.fixture(scope="module")
def vectors(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


@pytest.fixture(scope="module")
def odd_vectors(spark):
    """Null, empty, zero and non-finite vectors, null ids and labels, repeated rows, other lengths, clashing names."""
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(3).tolist(), i % 2) for i in range(60)]
    rows += [(100 + i, [1.0 + i, 2.0 + 2 * i, 3.0 + 3 * i], 0) for i in range(5)]  # of one direction
    rows += [(200, None, 0), (201, [], 0), (202, [0.0, 0.0, 0.0], 0), (203, [NAN, 1.0, 1.0], 0), (204, [INF, 1.0, 1.0], 0)]
    rows += [(205, [None, 1.0, 1.0], 0), (206, [1.0, 2.0], 0), (250, [2.0, 4.0], 0), (207, [1.0, 2.0, 3.0], None)]
    rows += [(None, [1.0, 2.0, 3.0], 0), (100, [1.0, 2.0, 3.0], 0), (0, rows[0][1], 0), (208, [-0.0, 1e200, 0.0], 1)]
    rows += [(209, [0.0, 1e-200, 0.0], 1), (150, [0.1, 0.0, 0.0], 1), (150, [0.1, 0.0, 0.0], 1), (300, [1e19, 0.0, 5.0], 1)]
    return spark.createDataFrame(
        [(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<double>, label int, rank int, rep string"
    ).repartition(3)


def usable(x):
    return x is not None and all(v is not None and math.isfinite(v) for v in x)


def whole(x):
    return [max(-(2**63), min(2**63 - 1, math.floor(256 * v))) for v in x]


def wrapped(n):
    return (n + 2**63) % 2**64 - 2**63


def plain_top(rows, k, every):
    rows = [(i, whole(x)) for i, x in rows if i is not None and usable(x)]
    out = set()
    for q, x in rows:
        if q % every == 0:
            found = [(-wrapped(sum(a * b for a, b in zip(x, y))), c) for c, y in rows if c != q and len(x) == len(y)]
            out |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(sorted(found)[:k])}
    return out


@pytest.mark.parametrize("name,every", [("vectors", 50), ("odd_vectors", 10), ("odd_vectors", 1)])
@pytest.mark.parametrize("block", [16, 4096])
def test_top_k(request, monkeypatch, name, every, block):
    monkeypatch.setattr(topk_search, "BLOCK", block)
    df = request.getfixturevalue(name)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    if every == 1:  # no product that leaves 64 bits: there the bounds don't hold
        df = df.where("vec_id not in (208, 300)")
        rows = [r for r in rows if r[0] not in (208, 300)]
    got = topk_search.exact_top_k(df, F.col("vec_id") % every == 0, 5).collect()
    assert {tuple(r) for r in got} == plain_top(rows, 5, every)
    assert len(got) == len({tuple(r) for r in got})


@pytest.mark.parametrize("dims,spread", [(8, 3), (64, 100), (1, 2), (3, 10**9)])
def test_index_is_exact(dims, spread):
    rng = np.random.default_rng(dims)
    vectors = rng.integers(-spread, spread + 1, (700, dims))
    vectors[::7] = vectors[0]  # ties
    ids = rng.permutation(700)
    index = topk_search.ImpactIndex(ids, vectors)
    for q in range(25):
        scores = (vectors * vectors[q]).sum(axis=1)
        want = sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist()) if i != ids[q])[:5]
        got_ids, got_scores = index.top(vectors[q], 5, int(ids[q]))
        assert list(zip((-got_scores).tolist(), got_ids.tolist())) == want


def test_index_stops_early_where_it_can():
    rng = np.random.default_rng(3)
    vectors = np.zeros((4000, 32), np.int64)
    vectors[np.arange(4000), rng.integers(0, 32, 4000)] = rng.integers(1, 100, 4000)
    index = topk_search.ImpactIndex(np.arange(4000), vectors)
    scored = []
    exact = index.exact
    index.exact = lambda rows, q: scored.append(len(rows)) or exact(rows, q)
    index.top(vectors[0], 5, 0)
    assert scored[-1] < 400


def plain_groups(rows, threshold):
    unit = []
    for _, x, label in rows:
        ok = usable(x) and label is not None and any(x)
        top = max(map(abs, x)) if ok else 1
        unit.append(np.array(x) / top / np.linalg.norm(np.array(x) / top) if ok else None)
    n = len(rows)
    parent, links = list(range(n)), [0] * n

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(n):
        for j in range(i):
            if unit[i] is None or unit[j] is None or rows[i][2] != rows[j][2] or len(unit[i]) != len(unit[j]):
                continue
            if unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if root(j) == root(i) and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((vec_id, links[i], least, vec_id is not None and vec_id == least))
    return out


def test_groups_of_odd_vectors(odd_vectors):
    rows = [(r.vec_id, r.embedding, r.label) for r in odd_vectors.collect()]
    got = [tuple(r) for r in vector_dedup.near_duplicate_vectors(odd_vectors, 0.93).collect()]
    assert sorted(got, key=str) == sorted(plain_groups(rows, 0.93), key=str)


def crowded(rng):
    """Labels with tight crowds, pairs at the threshold, chains and scattered vectors."""
    rows, vec_id = [], 0
    for label in range(2):
        centres = rng.standard_normal((40, 16))
        points = [centres[0] + 0.05 * rng.standard_normal(16) for _ in range(500)]
        points += [centres[1] * (1 + i) for i in range(60)]  # one direction, all different
        points += [c + 0.12 * rng.standard_normal(16) for c in centres for _ in range(4)]
        points += list(rng.standard_normal((300, 16)))
        points += points[:50]
        for p in points:
            rows.append((vec_id, p.tolist(), label))
            vec_id += 1
    return rows


def test_forest_finds_links(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "LEAF", 32)
    monkeypatch.setattr(vector_dedup, "LARGEST_LEAF", 64)
    monkeypatch.setattr(vector_dedup, "SAMPLE", 300)
    monkeypatch.setattr(vector_dedup, "LEVELS", 2)
    monkeypatch.setattr(vector_dedup, "CHUNK", 50)
    rows = crowded(np.random.default_rng(4))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r[0]: tuple(r) for r in vector_dedup.near_duplicate_vectors(df, 0.93).collect()}
    want = {r[0]: r for r in plain_groups(rows, 0.93)}
    assert got.keys() == want.keys()
    found, there = sum(r[1] for r in got.values()), sum(r[1] for r in want.values())
    assert max(r[1] for r in got.values()) > vector_dedup.CHUNK  # so cores and chunks are at work
    assert all(got[i][1] <= want[i][1] for i in want)  # no link below the threshold
    assert found >= 0.98 * there
    assert sum(got[i] == want[i] for i in want) >= 0.95 * len(want)


@pytest.mark.parametrize("forest_bytes", [1, 1 << 26])
def test_vectors_go_down_the_trees_where_they_are(spark, monkeypatch, forest_bytes):
    """No table that is written has a row for each tree, however many there are and however many are cut at once."""
    monkeypatch.setattr(vector_dedup, "FOREST_BYTES", forest_bytes)
    monkeypatch.setattr(vector_dedup, "LEAF", 16)
    monkeypatch.setattr(vector_dedup, "LEVELS", 1)  # so trees grow in several steps
    written, keep = {}, vector_dedup.materialise

    def watched(df, purpose):
        out = keep(df, purpose)
        written[purpose] = max(written.get(purpose, 0), out.count())
        return out

    monkeypatch.setattr(vector_dedup, "materialise", watched)
    rng = np.random.default_rng(8)
    points = rng.standard_normal((300, 8))
    points = np.concatenate((points, points + 0.02 * rng.standard_normal((300, 8))))
    rows = [(i, x, i % 3) for i, x in enumerate(points.tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = [tuple(r) for r in vector_dedup.near_duplicate_vectors(df, 0.98, largest_leaf=64).collect()]
    want = plain_groups(rows, 0.98)
    assert sum(r[1] for r in got) >= 0.95 * sum(r[1] for r in want) > 0
    assert max(written.values()) <= len(rows)


def test_one_batch_reaches_the_leaves_of_many_nodes():
    """All groups and nodes of a batch go down a tree together: as a walk of each vector by itself does."""
    rng = np.random.default_rng(9)
    groups = np.array([7, -5, 3])
    forest = vector_dedup._Forest(groups, range(2))
    unit, grp, jitter = vector_dedup._unit(rng.standard_normal((500, 6))), rng.choice(groups, 500), rng.random(500)
    nodes = {}  # leaf: level, edges, first of the leaves below it

    def cut(leaf, level, levels):
        first = len(forest.depth)
        edges = np.sort(rng.normal(0, 0.5, ((1 << levels) - 1, 2)))
        forest.grow({leaf: edges})
        nodes[leaf] = (level, edges, first)
        return first

    below = [cut(leaf, 0, 1 + leaf % 3) for leaf in range(6) if leaf != 4]
    cut(below[0] + 1, 1, 2)
    for tree in range(2):
        directions = vector_dedup._directions(tree, 8, 6)
        want = set()

        def walk(i, leaf):
            if leaf not in nodes:
                want.add((i, leaf))
                return
            level, edges, first = nodes[leaf]
            at = [(0, level)]
            while at:
                node, k = at.pop()
                if node >= len(edges):
                    walk(i, first + node - len(edges))
                    continue
                along = unit[i] @ directions[k] + 1e-7 * jitter[i]
                if along <= edges[node, 1]:
                    at.append((2 * node + 1, k + 1))
                if along >= edges[node, 0]:
                    at.append((2 * node + 2, k + 1))

        for i in range(500):
            walk(i, sorted(groups).index(grp[i]) * 2 + tree)
        rows, leaf = forest.leaves(grp, unit, jitter, tree)
        assert len(rows) == len(want) > 500 and set(zip(rows.tolist(), leaf.tolist())) == want


def test_given_vectors(vectors):
    rows = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()]
    got = [tuple(r) for r in vector_dedup.near_duplicate_vectors(vectors, 0.4).collect()]
    assert sorted(got) == sorted(plain_groups(rows, 0.4))


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert topk_search.exact_top_k(none, F.col("vec_id") % 2 == 0).collect() == []
    assert vector_dedup.near_duplicate_vectors(none).collect() == []
    few = spark.createDataFrame([(1, [1.0], 1)], "vec_id bigint, embedding array<float>, label int")
    assert topk_search.exact_top_k(few, F.col("vec_id") % 2 == 0).collect() == []
    assert [tuple(r) for r in vector_dedup.near_duplicate_vectors(few).collect()] == [(1, 0, 1, True)]


def test_a_tight_group_is_counted_without_comparing_it(spark, monkeypatch):
    """Near copies of one vector, with copies and a few others around: counts are exact, and no pairs of chunks of the group meet."""
    monkeypatch.setattr(vector_dedup, "CHUNK", 40)
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(32)
    points = [centre + 0.02 * rng.standard_normal(32) for _ in range(600)]
    points += [centre + 0.075 * rng.standard_normal(32) * 4 for _ in range(30)] + points[:20] * 3
    rows = [(i, p.tolist(), 1) for i, p in enumerate(points)]
    met = []
    counts = vector_dedup._by_group

    def watched(df, key, compare, schema):
        if key == "grp":
            met.append(df.count())
        return counts(df, key, compare, schema)

    monkeypatch.setattr(vector_dedup, "_by_group", watched)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = [tuple(r) for r in vector_dedup.near_duplicate_vectors(df, 0.93).collect()]
    assert sorted(got) == sorted(plain_groups(rows, 0.93))
    assert met[0] <= 4 * len(points)


def test_different_queries_of_one_id_stay_apart(spark):
    """Python's hash of (-1, ...) equals that of (-2, ...)."""
    rows = [(0, [-1.0, 0.0]), (0, [-2.0, 0.0]), (1, [1.0, 0.0]), (3, [-3.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = topk_search.exact_top_k(df, F.col("vec_id") == 0, 2, scale=1.0).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got) == [(1, 3, 3), (1, 3, 6), (2, 1, -2), (2, 1, -1)]
