"""Whitening against numpy's eigenvectors, and the qd solver on hard spectra."""

from __future__ import annotations

import numpy as np
import pytest

from vellum.llm import whitening
from vellum.llm.bidiagonal import right_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, W string"


def spectra():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    with_values = lambda v: np.linalg.qr(np.sqrt(np.array(v))[:, None] * q, mode="r")
    chain = np.diag(np.abs(np.arange(21) - 10.0) + 6) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    return {
        "random": np.linalg.qr(rng.standard_normal((200, 40)), mode="r"),
        "graded": np.linalg.qr(rng.standard_normal((200, 40)) * 10.0 ** -np.arange(40), mode="r"),
        "repeated": with_values([5.0] * 3 + [3] * 4 + [1] * 33),
        "near": with_values([5.0, 5 * (1 + 1e-13), 5 * (1 + 1e-9), 5 * (1 - 1e-6)] + [3] * 4 + [1] * 32),
        "pairs": np.linalg.cholesky(chain).T,
        "low rank": np.linalg.qr(rng.standard_normal((200, 3)) @ rng.standard_normal((3, 40)), mode="r"),
        "identity": np.eye(12), "one": np.array([[2.0]]), "diagonal with zeros": np.diag([3.0, 0, 2, 0]), "zero": np.zeros((3, 3)),
    }


@pytest.mark.parametrize("name", list(spectra()))
def test_solver(name):
    r = spectra()[name]
    values, w = right_vectors(r, 10)
    want = np.linalg.svd(r, compute_uv=False) ** 2
    assert np.abs(values - want).max() <= 1e-13 * max(want[0], 1e-300)
    rank = int(np.sum(want > 1e-25 * want[0]))
    assert len(w) == min(10, rank)
    if len(w):
        assert np.abs(w @ w.T - np.eye(len(w))).max() < 1e-11
        assert np.abs(r.T @ (r @ w.T) - w.T * values[:len(w)]).max() < 1e-12 * want[0]


def brute(rows, k=8):
    kept = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in kept]
    d = max(set(sizes), key=lambda s: (sizes.count(s), s))
    kept = [(i, v) for i, v in kept if len(v) == d]
    x = np.floor(1024 * np.array([np.array(v, np.float32) for _, v in kept]).astype(np.float64)).astype(np.int64) + 100000
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
    return kept, n, dev, y @ u / np.sqrt(e), e / np.trace(y.T @ y / n)


def test_whitening_is_that_of_the_eigenvectors(spark):
    rng = np.random.default_rng(3)
    good = (rng.standard_normal((300, 12)) * np.linspace(0.4, 0.05, 12)).astype(np.float32).tolist()
    odd = [None, [], [None] * 12, [float("nan")] * 12, [0.1] * 11 + [float("inf")], [0.5] * 3]
    rows = [(i if i % 9 else None, v) for i, v in enumerate(good + odd + good[:4])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(5)
    got = whitening.whiten(df).collect()
    kept, n, dev, w, share = brute(rows)
    assert len(got) == 8 * len(kept) and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9
    share_of = {r.component: r.explained for r in got}
    assert np.allclose([share_of[c + 1] for c in range(8)], share, rtol=1e-9)
    for c in range(8):
        mine = sorted(((r.vec_id is None, r.vec_id or 0, r.deviation), r.whitened) for r in got if r.component == c + 1)
        want = sorted(((i is None, i or 0, dv), x) for (i, _), dv, x in zip(kept, dev, w[:, c], strict=True))
        assert [a for a, _ in mine] == [a for a, _ in want]
        a, b = np.array([x for _, x in mine]), np.array([x for _, x in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-7


def test_factors_meet_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, rng.standard_normal(5).tolist(), 1, "x") for i in range(90)], SCHEMA)
    many, one = whitening.fit(df.repartition(9)), whitening.fit(df.coalesce(1))
    assert many.n == 90 and many.sums == one.sums
    assert np.allclose(many.values, one.values, rtol=1e-12) and np.allclose(many.directions, one.directions, atol=1e-9)


def test_tables_without_variance_or_rows(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    same = spark.createDataFrame([(i, [0.5, 0.25], 1, "x") for i in range(6)], SCHEMA)
    assert whitening.whiten(same).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0], 1, "x") for i in range(6)], SCHEMA)
    assert {r.component for r in whitening.whiten(line).collect()} == {1}


def test_entries_beyond_a_long(spark):
    df = spark.createDataFrame([(i, [3e38 * (-1) ** i, float(i)], 1, "x") for i in range(4)], SCHEMA)
    got = whitening.whiten(df).collect()
    assert {r.deviation for r in got} == {None} and all(np.isfinite(r.whitened) for r in got)
