"""Whitening against numpy in double precision and exact whole numbers."""

import numpy as np
import pytest

from tidemark.llm import whitening

COLUMNS = "vec_id component n deviation whitened explained identity_error".split()


def plain(vectors):
    """Sums, eigenvalues and eigenvectors of the distinct whole vectors."""
    x = np.unique(vectors, axis=0)
    n, s = len(x), x.sum(0)
    c = x - s / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    return n, s, values[::-1], axes[:, ::-1]


def whole(rows):
    return np.array([[int(np.floor(256.0 * v)) for v in r] for r in rows], dtype=object).astype(np.int64)


def compare(got, ids, x, components):
    n, s, values, axes = plain(x)
    assert len(got) == len(ids) * components
    assert {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    for c in range(components):
        rows = sorted((r for r in got if r.component == c + 1), key=lambda r: (r.vec_id, r.deviation))
        order = sorted(range(len(ids)), key=lambda i: (ids[i], sum((n * int(v) - int(t)) ** 2 for v, t in zip(x[i], s))))
        want = (x[order] - s / n) @ axes[:, c] / np.sqrt(values[c])
        mine = np.array([r.whitened for r in rows])
        sign = np.sign(mine @ want)
        assert np.abs(mine - sign * want).max() < 1e-9
        assert [r.deviation for r in rows] == [sum((n * int(v) - int(t)) ** 2 for v, t in zip(x[i], s)) for i in order]
        assert abs(rows[0].explained - values[c] / values.sum()) < 1e-12


def test_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = table.collect()
    got = whitening.digest(whitening.fit(table).whitened(4)).collect()
    assert [*got[0].asDict()] == COLUMNS
    compare(got, [r.vec_id for r in rows], whole([r.embedding for r in rows]), 4)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = [[float(v) for v in rng.normal(size=3)] for _ in range(200)] + [[-0.0, 0.0, 1.5]] * 3
    rows = [(i, v, i, 0.0) for i, v in enumerate(good)]
    bad = [None, [], [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], [1.0, 2.0], [1.0] * 4]
    rows += [(1000 + i, v, 1, 1.0) for i, v in enumerate(bad)] + [(5, good[5], 2, 2.0)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, X int, whitened double").repartition(4)
    got = whitening.digest(whitening.fit(table).whitened(4)).collect()
    ids = [i for i, _ in enumerate(good)] + [5]
    compare(got, ids, whole([*good, good[5]]), 3)


def test_without_variance(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert whitening.fit(spark.createDataFrame([], schema)).whitened(4).collect() == []
    same = spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.0, 2.0])], schema)
    got = whitening.fit(same).whitened(4).collect()
    assert {(r.vec_id, r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in got} == {
        (i, c, 1, 0, None, None, None) for i in (1, None) for c in (1, 2)
    }
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], schema)
    got = whitening.fit(line).whitened(4).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in got)
    assert all(r.explained == pytest.approx(1.0) for r in got if r.component == 1)


def test_entries_out_of_range_are_refused(spark):
    rows = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="too large to whiten exactly"):
        whitening.fit(rows)


def test_large_numbers_stay_exact(spark):
    rows = [(i, [60000.0 - 5 * (i % 7), -65000.0 + i]) for i in range(50)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    compare(whitening.fit(table).whitened(2).collect(), [i for i, _ in rows], whole([v for _, v in rows]), 2)


SPECTRA = {
    "random": np.random.default_rng(4).random(40),
    "clusters": np.r_[[5.0] * 8, [5 + 1e-9] * 4, [1.0] * 10, np.linspace(0.1, 0.9, 18)],
    "tiny": np.r_[1e-12 * np.arange(1, 21), np.arange(1.0, 21)],
    "one value": np.ones(40),
    "no rank": np.r_[np.zeros(30), np.arange(1.0, 11)],
}


@pytest.mark.parametrize("name", SPECTRA)
@pytest.mark.parametrize("size", [1.0, 1e60])
def test_eigenvectors(name, size):
    rng = np.random.default_rng(1)
    axes = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    a = (axes * SPECTRA[name]) @ axes.T * size
    a = (a + a.T) / 2
    values, vectors = whitening.eigen(a)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-14 * 40 * size * max(1, SPECTRA[name].max())
    assert np.abs(vectors.T @ vectors - np.eye(40)).max() < 1e-13
    assert (np.diff(values) <= 1e-13 * size * SPECTRA[name].max()).all()


def test_refinement_gains_what_float32_lacks():
    rng = np.random.default_rng(7)
    axes = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    a = (axes * np.arange(1.0, 31)) @ axes.T
    a = (a + a.T) / 2
    rough = np.linalg.eigh(a.astype(np.float32))[1]
    assert np.abs(a @ rough - rough * np.arange(1.0, 31)).max() > 1e-7
    values, vectors = whitening.refine(a, rough)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12
