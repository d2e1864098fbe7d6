"""Extreme eigenpairs of a small symmetric matrix by contour integration.

An interval's eigenvectors are found by FEAST: the spectral projector is the contour integral of the
resolvent (z - V)^-1 around the interval, here a Gauss-Legendre sum over half a circle of complex shifted
solves (the other half is its conjugate). It is applied to some vectors, Rayleigh-Ritz in the span of the
result gives new vectors, and this is repeated until the residuals are at rounding level. Inertia
counts (the signs of D in V - s = L D L') say beforehand how many eigenvalues lie above a number;
they choose the intervals and prove afterwards that none was missed.
"""

from __future__ import annotations

import numpy as np

# Points of the half circle, rounds of subspace iteration, eigenvalues in an interval.
POINTS = 8
ROUNDS = 40
INTERVAL = 8
# Eigenvalues closer than this, relative to the largest, are taken together.
CLOSE = 1e-9
# Residuals, relative to the matrix, beyond which a result is refused.
TOLERANCE = 1e-11
EPS = np.finfo(float).eps


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared off-diagonal of a tridiagonal matrix with the same eigenvalues (reflections)."""
    a = np.array(matrix, dtype=float)
    n = len(a)
    beside = np.zeros(max(n - 1, 0))
    for k in range(n - 2):
        x = a[k + 1 :, k]
        size = np.linalg.norm(x)
        beside[k] = size
        if size == 0:
            continue
        v = x.copy()
        v[0] += np.copysign(size, v[0])
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
    if n > 1:
        beside[-1] = a[n - 1, n - 2]
    return np.diag(a).copy(), beside**2


def above(form: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """How many eigenvalues are larger than ``shift``: the positive pivots of L D L'."""
    diagonal, beside = form
    tiny = EPS * (np.abs(diagonal).max() + np.sqrt(beside.max(initial=0.0)) + np.finfo(float).tiny) ** 2
    pivot, positive = 1.0, 0
    for at, value in enumerate((diagonal - shift).tolist()):
        pivot = value - (beside[at - 1] / pivot if at else 0.0)
        if pivot == 0:
            pivot = -tiny
        positive += pivot > 0
    return positive


def _edge(form: tuple[np.ndarray, np.ndarray], count: int, full: float, empty: float, steps: int) -> float:
    """From ``empty`` towards ``full``, as far as ``count`` eigenvalues lie above."""
    for _ in range(steps):
        middle = (empty + full) / 2
        if above(form, middle) == count:
            empty = middle
        else:
            full = middle
    return empty


def cut_above(form: tuple[np.ndarray, np.ndarray], least: int, radius: float) -> tuple[float, int]:
    """A number below the ``least`` largest eigenvalues and how many lie above it: ``least``, or more where
    eigenvalues are too close to be told apart. All lie within ``radius`` of 0."""
    top, bottom = radius, -radius  # fewer than ``least`` above top, at least as many above bottom
    while above(form, bottom) != least and top - bottom > CLOSE * radius:
        middle = (top + bottom) / 2
        if above(form, middle) >= least:
            bottom = middle
        else:
            top = middle
    # The middle of the gap to the next one.
    count = above(form, bottom)
    return (_edge(form, count, -radius, bottom, 50) + _edge(form, count, radius, bottom, 50)) / 2, count


def intervals(matrix: np.ndarray, k: int, most: int = INTERVAL) -> list[tuple[float, float, int]]:
    """``low, high, count`` of intervals that hold the k largest eigenvalues, about ``most`` in each, from the
    top. Eigenvalues that cannot be told apart are in one interval, so there may be more than k."""
    radius = np.abs(matrix).sum(axis=1).max() * (1 + 1e-6) or 1.0
    form = tridiagonal(matrix)
    # Just above the largest: circles that hug the eigenvalues separate best.
    found, high, out = 0, _edge(form, 0, -radius, radius, 50) + 1e-6 * radius, []
    while found < min(k, len(matrix)):
        low, count = cut_above(form, min(found + most, k, len(matrix)), radius)
        out.append((low, high, count - found))
        found, high = count, low
    return out


def _project(matrix: np.ndarray, vectors: np.ndarray, low: float, high: float, points: int) -> np.ndarray:
    nodes, weights = np.polynomial.legendre.leggauss(points)
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(vectors)
    for x, w in zip(nodes, weights, strict=True):
        turn = np.exp(1j * np.pi / 2 * (1 - x))
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(matrix)) - matrix, vectors.astype(complex))
        out += w / 2 * radius * np.real(turn * solved)
    return out


def eigenpairs(matrix: np.ndarray, low: float, high: float, count: int, points: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between ``low`` and ``high``, falling, and their unit eigenvectors as columns."""
    d = len(matrix)
    scale = np.abs(matrix).sum(axis=1).max()
    size = min(d, 2 * count + 4)
    draw = np.random.default_rng(0)
    vectors = draw.standard_normal((d, size))
    last = np.inf
    for _ in range(ROUNDS):
        basis = np.linalg.qr(_project(matrix, vectors, low, high, points))[0]
        small = basis.T @ matrix @ basis
        values, mixed = np.linalg.eigh((small + small.T) / 2)
        vectors = basis @ mixed
        inside = np.flatnonzero((values > low) & (values < high))[::-1]
        slow = True
        if len(inside) == count:
            pairs = values[inside], vectors[:, inside]
            residual = np.abs(matrix @ pairs[1] - pairs[1] * pairs[0]).max() / scale
            slow = residual > last / 8
            # At rounding level, or as near to it as it gets.
            if residual <= EPS or (residual <= 64 * EPS and slow):
                return pairs
            last = residual
        if slow and size < d:  # others lie close to the interval: a larger space takes them in
            size = min(d, 2 * size)
            vectors = np.hstack([vectors, draw.standard_normal((d, size - vectors.shape[1]))])
    if last > TOLERANCE:
        raise ArithmeticError(f"{count} eigenvalues between {low} and {high}: residual {last}")
    return pairs
