"""The manifest against a plain version that builds whole trees and walks them row by row."""

import zlib
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[k : k + 3]) for k in range(0, len(last), 3)])
    return levels


def siblings(levels, i):
    for row in levels[:-1]:
        run = i - i % 3
        yield row[run:i], row[i + 1 : run + 3]
        i //= 3


def plain(rows):
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row."""
    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in order:
        held = sorted(groups[source], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees.append((held, levels_of([leaf_of(r) for r in held])))
    top = levels_of([t[-1][0] for _, t in trees])
    out = []
    for g, (held, tree) in enumerate(trees):
        for i, row in enumerate(held):
            steps = [*siblings(tree, i), *siblings(top, g)]
            read = row
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0 and row["text"] is not None:
                read = {**row, "text": row["text"].replace("\n", "")}
            node = leaf_of(read)
            for left, right in steps:
                node = h(*left, node, *right)
            proof = h(*(x for left, right in steps for x in (*left, *right)))
            out.append((row["doc_id"], leaf_of(row), tree[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


def ours(docs):
    found = merkle.checked(merkle.build(docs, carry=merkle.tampered(docs)).proofs())
    return sorted((tuple(r) for r in found.collect()), key=str)


def rows_of(docs):
    return [r.asDict() for r in docs.select(*FIELDS).collect()]


@pytest.fixture
def odd(spark):
    rows = [(i, f"line {i}\nand\n more", "en", 5, f"s{i % 3}") for i in range(40)]
    rows += [(i, "hot", None, i, "hot") for i in range(500)]
    rows += [(None, "no id\n", "en", 1, "s1"), (None, None, None, None, None), (3, None, "", 0, None), (7, "", "x", None, "")]
    rows += [(9, "same\n", "en", 2, "é")] * 4 + [(9, "other", "en", 2, "é"), (1 << 40, "big\n" * 9, "en", 1, "z\U0001f600"), (5, "x", "x", 1, "z￮")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_chars bigint, source string")
    return frame.selectExpr("*", "1 AS hash", "2 AS POS", "'x' AS carry", "3 AS Tree").repartition(5)


@pytest.mark.parametrize("chunk", [1, 2, 7, 64, 4096])
def test_every_chunk_size_gives_the_plain_result(spark, odd, monkeypatch, chunk):
    monkeypatch.setattr(merkle, "CHUNK", chunk)
    monkeypatch.setattr(merkle, "CROWN_LEVELS", 3)
    monkeypatch.setattr(merkle, "SPREAD", 4)
    rows = odd if chunk > 2 else odd.where("source IS NULL OR source <> 'hot'")
    assert ours(rows) == plain(rows_of(rows))


def test_documents(documents):
    assert ours(documents) == plain(rows_of(documents))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_few_rows(spark, n):
    rows = [(i, "a\nb", "en", 3, "one") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_chars bigint, source string")
    assert ours(docs) == plain(rows_of(docs))


def test_roots_and_own_fields(spark, odd):
    found = merkle.build(odd, fields=("doc_id", "text"))
    roots = {r.source: (r.n, r.subroot) for r in found.roots().collect()}
    assert roots["hot"][0] == 500 and len(roots) == odd.select("source").distinct().count()
    assert {r.subroot for r in found.proofs().collect()} == {s for _, s in roots.values()}


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 90), st.data())
def test_fetched_nodes_are_enough_and_none_too_many(n, data):
    lo = data.draw(st.integers(0, n - 1))
    hi = data.draw(st.integers(lo + 1, n))
    tree = levels_of([h(str(i)) for i in range(n)])
    wanted = [*merkle.missing(lo, hi, n)]
    root, paths = merkle.expand(tree[0][lo:hi], lo, n, {(level, i): tree[level][i] for level, i in wanted})
    assert root == tree[-1][0]
    for i, path in zip(range(lo, hi), paths):
        assert path == [("".join(left), "".join(right)) for left, right in siblings(tree, i)]
    # what is fetched holds no leaf of the range and no two nodes that make up a third
    for level, i in wanted:
        first, last = i * 3**level, min(n, (i + 1) * 3**level)
        assert last <= lo or first >= hi
    assert len(wanted) == len({*wanted})


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 90), st.data())
def test_chunks_put_out_what_their_neighbours_need(n, data):
    cuts = sorted({0, n, *data.draw(st.lists(st.integers(0, n), max_size=6))})
    tree = levels_of([h(str(i)) for i in range(n)])
    known = {}
    for lo, hi in zip(cuts, cuts[1:]):
        for level, i, found in merkle.climb(tree[0][lo:hi], lo, n):
            assert found == tree[level][i]
            known[level, i] = found
    for level in range(len(tree) - 1):
        for i in range(0, len(tree[level]), 3):
            if all((level, k) in known for k in range(i, min(i + 3, len(tree[level])))):
                known[level + 1, i // 3] = tree[level + 1][i // 3]
    for lo, hi in zip(cuts, cuts[1:]):
        assert all(k in known for k in merkle.missing(lo, hi, n))
