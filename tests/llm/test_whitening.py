"""Contour integration against a dense solver, whitening against numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tickloom.llm import feast, whitening
from tickloom.llm.queries import op13_whitening, table

SCHEMA = "vec_id long, embedding array<float>, x string, n long, component int"


def solved(matrix, k):
    values, vectors = [], []
    for low, high, count in feast.intervals(matrix, k):
        got = feast.eigenpairs(matrix, low, high, count)
        assert len(got[0]) == count
        values.extend(got[0])
        vectors.append(got[1])
    return np.array(values), np.hstack(vectors)


def matrices():
    draw = np.random.default_rng(1)
    for d in (1, 2, 3, 5, 64, 128):
        x = draw.standard_normal((500, d))
        yield x.T @ x / 500
    q = np.linalg.qr(draw.standard_normal((40, 40)))[0]
    yield q @ np.diag(1 + 1e-7 * np.arange(40)) @ q.T  # close together
    yield q @ np.diag(1 + 1e-12 * np.arange(40)) @ q.T  # not to be told apart
    yield q @ np.diag(np.logspace(0, -20, 40)) @ q.T
    yield np.eye(6) * 3
    yield np.diag([5.0, 5, 5, 1, 1, 0, 0])
    yield np.diag([1.0, 0, 0, 0])
    yield np.diag([-3.0, 2, 1, 0])


@pytest.mark.parametrize("matrix", list(matrices()), ids=lambda m: f"d{len(m)}")
def test_eigenpairs(matrix):
    matrix = (matrix + matrix.T) / 2
    for k in (1, 4, 12):
        values, vectors = solved(matrix, k)
        want = np.linalg.eigvalsh(matrix)[::-1]
        assert len(values) >= min(k, len(matrix))
        scale = np.abs(want).max()
        assert np.abs(values - want[: len(values)]).max() < 1e-13 * scale
        assert np.abs(matrix @ vectors - vectors * values).max() < 1e-13 * scale
        assert np.abs(np.linalg.norm(vectors, axis=0) - 1).max() < 1e-13


def test_inertia_counts():
    draw = np.random.default_rng(2)
    for d in (1, 2, 7, 30):
        a = draw.standard_normal((d, d))
        a = a + a.T
        form = feast.tridiagonal(a)
        for shift in draw.standard_normal(20) * 5:
            assert feast.above(form, shift) == (np.linalg.eigvalsh(a) > shift).sum()


def brute(rows, k=4):
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for _, v in kept])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    c = fit - sums / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return [i for i, _ in kept], n, deviation, (x - sums / n) @ vectors / np.sqrt(values), values / np.trace(c.T @ c / n)


def check(out, want):
    ids, n, deviation, white, shares = want
    got = out.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got - white * signs).max() < 1e-8
    assert (out["n"] == n).all() and (out["identity_error"] < 1e-10).all() and out["identity_error"].nunique() == 1
    first = out[out["component"] == 1].set_index("vec_id")
    assert first.loc[ids, "deviation"].tolist() == deviation
    assert out.groupby("component")["explained"].first().to_numpy() == pytest.approx(shares, rel=1e-10)
    assert len(out) == len(ids) * white.shape[1]


def test_query_over_the_whole_table(shipped, small):
    rows = [(r["vec_id"], r["embedding"]) for r in table(shipped, small, "embeddings").collect()]
    check(op13_whitening(shipped, small).toPandas(), brute(rows))


def test_odd_vectors(shipped):
    """A far mean, copies, and vectors that take no part."""
    draw = np.random.default_rng(4)
    rows = [(i, (1e6 + draw.standard_normal(6) * [9, 7, 5, 3, 2, 1]).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]
    odd = [(2000, None), (2001, [1.0, None, 1, 1, 1, 1]), (2002, [math.nan] * 6), (2003, [math.inf, 1, 1, 1, 1, 1]), (2004, [1.0, 2.0]), (2005, [])]
    every = [(i, None if v is None else [None if c is None else float(c) for c in v], "x", 5, 6) for i, v in rows + odd]
    out = whitening.whitened(shipped.createDataFrame(every, SCHEMA)).toPandas()
    check(out, brute(rows))


def test_nothing_to_whiten(shipped):
    for rows in ([], [(1, None)], [(1, []), (2, [])], [(1, [0.5, 0.5])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])]):
        table = shipped.createDataFrame([(*r, "x", 1, 1) for r in rows], SCHEMA)
        assert whitening.whitened(table).count() == 0


def test_fewer_components_than_asked(shipped):
    rows = [(None if i == 3 else i, [float(i), 2.0 * i, 7.0], "x", 1, 1) for i in range(10)]
    out = whitening.whitened(shipped.createDataFrame(rows, SCHEMA)).toPandas()
    assert len(out) == 10 and out["component"].unique().tolist() == [1] and out["explained"].iloc[0] == pytest.approx(1)


def test_deviations_beyond_64_bits():
    x = np.array([[1 << 60, 0], [3, -5]])
    assert whitening.deviations(x, 2, (4, 6)) == [None, 4 + 256]
    assert whitening.deviations(np.array([[1 << 40]]), 1 << 24, ((1 << 64) + 9,)) == [81]
