from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import cover_tree


def plain(rows, every=50, k=5):
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    out = []
    for q, a in whole.items():
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole.items() if i != q)
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def clustered():
    dice = np.random.default_rng(5)
    centres = dice.normal(size=(6, 12))
    points = centres[dice.integers(0, 6, 700)] + dice.normal(scale=0.1, size=(700, 12))
    points[::3] = points[0]  # a third of all rows is one vector: ties by id
    return [(i, [float(x) for x in p]) for i, p in enumerate(points.astype(np.float32))]


@pytest.mark.parametrize("sizes", [(4096, 2048, 2048), (40, 3, 30), (1, 1, 1)])
def test_against_brute_force(spark, shipped, clustered, sizes):
    block, query_block, sample = sizes
    rows = clustered if block > 1 else clustered[:120]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = cover_tree.top_products(
        frame, F.col("vec_id") % 50 == 0, block=block, query_block=query_block, sample=sample, pivots=7
    ).collect()
    assert sorted(tuple(r) for r in got) == plain(rows)


def test_odd_rows(spark, shipped):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
        (5, [3.0, 0.5]), (None, [9.0, 9.0]), (6, [1.0, 2.0, 3.0]), (7, []), (50, [-0.001, 0.0]),
    ]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = sorted(tuple(r) for r in cover_tree.top_products(frame, F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 5, 256 * 768 + 512 * 128), (0, 2, 50, -256), (50, 1, 0, -256), (50, 2, 5, -768)]
    assert cover_tree.top_products(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_large_components_stay_exact():
    a = np.array([[2**30, 3]], dtype=np.int64)
    assert cover_tree.scores(a, a).tolist() == [[2**60 + 9]]


def test_bound_holds_for_every_pair():
    dice = np.random.default_rng(1)
    a, b = dice.normal(size=(300, 5)), dice.normal(size=(300, 5)) + 2

    def nodes(node):
        yield node
        for child in node.children:
            yield from nodes(child)

    left, right = (list(nodes(cover_tree.Node(p, np.arange(300)))) for p in (a, b))
    for x in left[::3]:
        for y in right[::3]:
            assert (a[x.rows] @ b[y.rows].T).max() <= cover_tree.bound(x, y) + 1e-9
    assert sorted(np.concatenate([n.rows for n in left if not n.children]).tolist()) == list(range(300))


@pytest.mark.parametrize("seed", range(5))
def test_ties_of_large_scores_are_not_pruned(seed):
    """Sums of 2^60 in another order: doubles round them differently, the scores are equal."""
    dice = np.random.default_rng(seed)
    query = np.full((1, 8), (1 << 28) + 1, dtype=np.int64)
    one = dice.integers(1 << 28, 1 << 29, 8)
    orders = np.array([dice.permutation(one) for _ in range(12)])
    ids = np.arange(1, 1201)
    search = cover_tree.Search(np.array([0]), query, np.array([-(1 << 62)]), ids, orders[ids % 12], 5)
    assert search.best[0] == [(-int(query[0] @ one), i) for i in range(1, 6)]
