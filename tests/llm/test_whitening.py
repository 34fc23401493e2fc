"""Whitening against dense linear algebra and exact integers."""

import numpy as np
import pytest

from conftest import SF001
from daybook.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<double>, id string, x string, component int, n int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 0, 0) for r in rows], SCHEMA)


def spectra(n, rng):
    a = rng.standard_normal((n, n))
    q = np.linalg.qr(a)[0]
    yield a @ a.T
    yield np.diag(np.repeat(rng.random(n // 2 + 1) * 5, 2)[:n])  # pairs, no off-diagonal
    c = q @ np.diag(np.repeat([5.0, 5.0, 3.0, 1e-9], n)[:n]) @ q.T
    yield (c + c.T) / 2  # one cluster
    yield np.pad(np.eye(min(n, 3)) * 2, (0, n - min(n, 3)))  # low rank
    yield np.zeros((n, n))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 40, 90])
def test_eigenpairs(n):
    for cov in spectra(n, np.random.default_rng(n)):
        values, axes = wh.principal(cov, 8)
        want = np.linalg.eigvalsh(cov)[::-1][:8]
        size = max(np.abs(want).max(), 1e-300)
        assert np.abs(values - want).max() <= 1e-12 * size and np.abs(axes @ axes.T - np.eye(len(values))).max() < 1e-10
        assert np.abs(cov @ axes.T - axes.T * values).max() <= 1e-10 * size


def test_sturm_counts():
    rng = np.random.default_rng(1)
    d, e = rng.standard_normal(12), rng.standard_normal(11)
    ev = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.linspace(-5, 5, 41)
    assert wh.sturm_count(d, e * e, at, 1e-300).tolist() == [(ev < x).sum() for x in at]


def check(rows, got, k=8):
    x = np.array([[int(np.floor(1024 * c)) + 100_000 for c in v] for _, v in rows], object)
    n, s = len(x), x.sum(0)
    z = (x - s / n).astype(float)
    ev, axes = np.linalg.eigh(z.T @ z / n)
    ev, axes = ev[::-1][:k], axes[:, ::-1][:, :k]
    want = z @ axes / np.sqrt(ev)
    order = {i: at for at, (i, _) in enumerate(rows)}
    w = np.zeros((n, len(ev)))
    for r in got:
        at = order[r.vec_id if hasattr(r, "vec_id") else r.id]
        w[at, r.component - 1] = r.whitened
        assert r.n == n and int(r.deviation) == sum((n * a - b) ** 2 for a, b in zip(x[at], s, strict=True))
        assert abs(r.explained / (ev[r.component - 1] / np.trace(z.T @ z / n)) - 1) < 1e-9 and r.identity_error < 1e-9
    assert len(got) == n * len(ev) and np.abs(w * np.sign((w * want).sum(0)) - want).max() < 1e-6


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    check(rows, wh.op13_whitening(spark, SF001).collect())


def test_few_dimensions_and_large_numbers(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(size=3) * (1, 1e3, 0.1)]) for i in range(60)]
    check(rows, wh.whiten(vectors_of(spark, rows)).collect(), 3)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(0, None), (1, []), (2, [nan, 1.0]), (3, [None, 1.0]), (4, [inf, 1.0]), (5, [1.0])]
    assert wh.whiten(vectors_of(spark, bad[:5])).collect() == [] == wh.whiten(vectors_of(spark, [])).collect()
    assert wh.whiten(vectors_of(spark, [(1, [1.0, 2.0])] * 3)).collect() == []
    got = wh.whiten(vectors_of(spark, [*bad, (6, [0.0, 1.0]), (6, [1.0, 1.0]), (None, [1.0, 1.0])])).collect()
    assert sorted((r.id is None, r.component, r.n) for r in got) == [(False, 1, 3), (False, 1, 3), (True, 1, 3)]
    assert all(abs(r.explained - 1) < 1e-9 and r.identity_error < 1e-9 for r in got)
    far = wh.whiten(vectors_of(spark, [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 5.0])])).collect()
    assert far and all(int(r.deviation) > 0 for r in far)
