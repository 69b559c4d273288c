"""Fingerprints by their definition, and groups against all pairs."""

import re

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import components
from tidemark.workspace import materialise


def plain_fingerprint(text, k=4):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(pairs, distance):
    """Per row: the least id reachable."""
    parent = list(range(len(pairs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    prints = np.array([p for _, p in pairs], np.uint64)
    for i in range(len(pairs)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= distance):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc_id, _) in enumerate(pairs):
        least.setdefault(root(i), []).append(doc_id)
    return [min((x for x in least[root(i)] if x is not None), default=None) for i in range(len(pairs))]


@pytest.mark.parametrize("name", ["odd_docs", "documents", "no_docs"])
def test_groups(request, name):
    docs = request.getfixturevalue(name)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    prints = [(d, plain_fingerprint(t)) for d, t in rows]
    want = [(d, f"{p:016x}", c) for (d, p), c in zip(prints, plain_groups(prints, 4))]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("distance,blocks", [(4, 7), (4, 5), (2, 6), (0, 1)])
def test_links_of_crowded_fingerprints(spark, monkeypatch, distance, blocks):
    """Many fingerprints around few centres: keys above the chunk size, and chains of close pairs."""
    monkeypatch.setattr(simhash, "CHUNK", 16)
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**64, 6, dtype=np.uint64)
    prints = set(rng.integers(0, 2**64, 200, dtype=np.uint64).tolist())
    for _ in range(600):
        flips = rng.integers(0, 64, rng.integers(0, 7))
        prints.add(int(centres[rng.integers(0, 6)] ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))))
    pairs = list(enumerate(sorted(prints)))
    df = spark.createDataFrame([(i, int(np.uint64(p).astype(np.int64))) for i, p in pairs], "doc_id bigint, bits bigint")
    groups = simhash.fingerprint_groups(df, distance, blocks)
    got = {r.doc_id: r.component_id for r in df.join(groups, "bits").collect()}
    assert got == dict(zip(range(len(pairs)), plain_groups(pairs, distance)))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 100: 90, 95: 90, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_keys_are_merged_with_their_counts(spark, plan_of):
    """The keys of few fingerprints look small, but there are 35 of each: neither side may go to the driver."""
    distinct = materialise(spark.createDataFrame([(i * 7919,) for i in range(50)], "bits bigint"), "test")
    plan = plan_of(simhash.close_links(distinct, 4, 7), "simple")
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
