"""Whitening: the eigen solver against LAPACK, the frames against numpy."""

import numpy as np
import pytest

from tessera.llm import whitening
from tessera.llm.whitening import jacobi_davidson


def _matrices():
    rng = np.random.default_rng(5)
    noise = rng.standard_normal((500, 64))
    yield "noise", np.cov(noise.T)
    yield "wide", np.cov(rng.standard_normal((600, 200)).T)
    yield "falling", np.cov((rng.standard_normal((600, 200)) * 0.9 ** np.arange(200)).T)
    yield "equal", np.eye(50)
    yield "pairs", np.diag(np.repeat(np.arange(1.0, 60), 2))
    yield "rank", np.cov((rng.standard_normal((300, 5)) @ rng.standard_normal((5, 80))).T)
    yield "small", np.cov(noise[:, :3].T)
    yield "one", np.array([[2.0]])
    yield "zero", np.zeros((7, 7))


@pytest.mark.parametrize("name, a", list(_matrices()))
def test_largest_eigenpairs(name, a):
    got = jacobi_davidson(lambda x: a @ x, len(a), 32)
    w = np.linalg.eigvalsh(a)[::-1]
    k = {"rank": 5, "zero": 0}.get(name, min(32, len(a)))
    assert len(got.values) == k
    if k:
        assert np.abs(got.values - w[:k]).max() < 1e-12 * w[0]
        assert np.abs(a @ got.vectors - got.vectors * got.values).max() < 2e-13 * w[0]
        assert np.abs(got.vectors.T @ got.vectors - np.eye(k)).max() < 1e-13


def test_minres_solves():
    rng = np.random.default_rng(6)
    a = rng.standard_normal((30, 30))
    a = a + a.T  # indefinite
    b = rng.standard_normal((30, 4))
    b[:, 3] = 0
    x = whitening.minres(lambda v: a @ v, b, 60)
    assert np.abs(a @ x - b).max() < 1e-8


def _check(rows, vectors, k):
    """Against numpy: vectors is (id, entries) of the rows that should be kept."""
    x = np.floor(64 * np.array([v for _, v in vectors], float)).astype(int) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    y = (x * n - s) / n
    w, q = np.linalg.eigh(y.T @ y / n)
    w, q = w[::-1][:k], q[:, ::-1][:, :k]
    z = y @ q / np.sqrt(w)
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    got = {}
    for r in rows:
        got.setdefault(r.component, []).append((r.vec_id, int(r.deviation), r.whitened))
        assert r.n == n and abs(r.explained - w[r.component - 1] / np.square(y).sum() * n) < 1e-10 and 0 <= r.identity_error < 1e-10
    assert sorted(got) == list(range(1, k + 1))
    key = lambda t: (str(t[0]), t[1])
    for c, have in got.items():
        want = sorted(((i, d, v) for (i, _), d, v in zip(vectors, dev, z[:, c - 1])), key=key)
        have.sort(key=key)
        assert [key(t) for t in have] == [key(t) for t in want]
        a, b = np.array([t[2] for t in have]), np.array([t[2] for t in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8


def test_frames(spark):
    rng = np.random.default_rng(7)
    good = [(i, [float(np.float32(c)) for c in rng.standard_normal(40) * np.arange(1, 41)]) for i in range(300)]
    good += [good[3], good[3], (None, good[5][1]), (7, good[9][1])]
    nan, inf = float("nan"), float("inf")
    bad = [(900, None), (901, []), (902, [nan] * 40), (903, [inf] + [0.0] * 39), (904, [None] + [1.0] * 39), (905, [1.0] * 7), (906, [1.0] * 41)]
    df = spark.createDataFrame([(i, v, "x", 1.5) for i, v in good + bad], "vec_id long, embedding array<float>, n string, whitened double").repartition(5)
    fitted = whitening.fit(df)
    assert fitted.n == len(good) and fitted.residual <= whitening.RESIDUAL
    _check(whitening.whiten(df, fitted).collect(), good, 32)
    few = whitening.fit(df, components=3)
    _check(whitening.whiten(df, few).collect(), good, 3)


def test_without_components(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5):
        df = spark.createDataFrame(rows, schema)
        assert whitening.whiten(df, whitening.fit(df)).count() == 0
    df = spark.createDataFrame([(1, [0.0, 5.0]), (2, [1.0, 5.0])], schema)
    rows = whitening.whiten(df, whitening.fit(df)).collect()
    assert sorted((r.vec_id, round(abs(r.whitened), 9), r.explained) for r in rows) == [(1, 1.0, 1.0), (2, 1.0, 1.0)]


def test_deviation_is_exact_when_long():
    x = np.array([[10**12, 5], [0, -3], [7, 7]])
    s = x.sum(axis=0)
    assert whitening.deviations(x, 3, s) == [sum((3 * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]


def test_rounding_of_sums_is_carried():
    blocks = [np.array([1.0]), *[np.array([1e-17])] * 1000, np.array([-1.0])]
    assert abs(whitening._summed(iter(blocks), 1)[0] - 1e-14) < 1e-18
