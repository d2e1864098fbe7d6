from __future__ import annotations

import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from tickloom.llm import queries, simhash
from tickloom.llm.components import components


def plain_fingerprint(text: str | None) -> int:
    """Straight from the definition."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps: list[int], radius: int = 2) -> list[int]:
    """For each position the smallest position within reach."""
    bits = np.array(fps, dtype=np.uint64)
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= radius
    label = np.arange(len(fps))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label.tolist()
        label = new


def test_query_against_brute_force(spark, small):
    rows = queries.op7_simhash(spark, small).toPandas().sort_values("doc_id")
    docs = pd.read_parquet(f"{small}/documents.parquet").sort_values("doc_id")
    fps = [plain_fingerprint(t) for t in docs["text"]]
    assert rows["fingerprint"].tolist() == [f"{f:016x}" for f in fps]
    ids = docs["doc_id"].tolist()
    assert rows["component_id"].tolist() == [ids[p] for p in plain_components(fps)]


@pytest.mark.parametrize("tile", [3, 50, 4096])
def test_links_of_crowded_fingerprints(spark, shipped, tile):
    """Clusters of near fingerprints, tiles cut and not cut: the components are those of all pairs."""
    dice = random.Random(tile)
    fps = set()
    for _ in range(25):
        centre = dice.getrandbits(64)
        for _ in range(12):
            near = centre
            for _ in range(dice.randrange(4)):
                near ^= 1 << dice.randrange(64)
            fps.add(near)
    values = sorted(fps)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = components(simhash.fingerprint_links(frame, tile=tile), "a", "b").collect()
    root = {r["node"]: r["root"] for r in roots}
    expected = plain_components(values)
    groups = {}
    for v, at in zip(signed, expected, strict=True):
        groups.setdefault(at, set()).add(root.get(v, v))
    assert all(len(g) == 1 for g in groups.values())
    assert len({g.pop() for g in groups.values()}) == len(set(expected))


def test_odd_rows(odd_docs):
    rows = {r["id"]: r for r in simhash.near_duplicates(odd_docs).collect()}
    assert simhash.near_duplicates(odd_docs).count() == odd_docs.count()
    assert [rows[i]["fingerprint"] for i in (0, 1, 2)] == [0, 0, 0]
    assert rows[3]["component"] == rows[4]["component"] == 3
    kept = simhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    # NULL text with NULL id joins the blank ones; the row without id but with text stays.
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [0, 3, 5, 6, 7]
    assert kept.filter(F.col("doc_id").isNull()).count() == 1


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.drop_near_duplicates(no_docs).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(5, 5), (7, 6)]
    rows = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r["node"]: r["root"] for r in rows} == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components(spark.createDataFrame([(1, 1)], "a long, b long"), "a", "b").count() == 0
