from __future__ import annotations

import random

import pytest

from tickloom.llm.components import components


def plain(links):
    """Smallest node that can be reached, by a walk."""
    near: dict[int, set[int]] = {}
    for a, b in links:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    roots = {}
    for start in sorted(near):
        if start in roots:
            continue
        todo = [start]
        while todo:
            node = todo.pop()
            if node not in roots:
                roots[node] = start
                todo += near[node]
    return roots


def graphs():
    dice = random.Random(8)
    yield "stars", [(500, n) for n in range(1000, 1200)] + [(n, 3000) for n in range(2000, 2150)] + [(1100, 2100)]
    yield "chain", [(n + 1, n) for n in range(60)] + [(60, 60), (None, 4), (4, None), (3, 4), (3, 4)]
    yield "random", [(dice.randrange(400), dice.randrange(400)) for _ in range(320)]
    yield "complete", [(a, b) for a in range(30) for b in range(30)]
    yield "none", []


@pytest.mark.parametrize("rows_per_slice", [16, 100_000])
@pytest.mark.parametrize(("name", "links"), [*graphs()])
def test_against_a_walk(spark, name, links, rows_per_slice):
    frame = spark.createDataFrame(links, "x long, y long").repartition(3)
    rows = components(frame, "x", "y", name, rows_per_slice).collect()
    expected = plain(links)
    assert len(rows) == len(expected)
    assert {r["node"]: r["root"] for r in rows} == expected
