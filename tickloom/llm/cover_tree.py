"""Exact k best inner products by dual-tree search over cover trees.

Components are whole numbers, floor(scale * x), so scores are exact integers. Vectors are dealt to cells
around pivots (the top level of the tree; the pivots are the farthest-first picks of a bounded sample),
large cells are cut into blocks, and queries are grouped into blocks along the cells. A task gets one
block of queries and one of vectors, builds a cover tree over each, and walks node pairs: no score between
two nodes exceeds

    <c, d> + r_c |d| + r_d |c| + r_c r_d        (centres c, d; covering radii r_c, r_d),

and a pair is dropped if that is below the worst k-th score of the query node. The same bound between a
query and a cell (radius zero for the query) decides which blocks are sent at all; the k-th score within
the sample is a first value for each query. All bounds use true covering radii, so nothing is lost.

The sample is bounded by ``SAMPLE`` and only steers the work. Every row is indexed; the result is exact.

Edge cases: vectors that are NULL or hold NULL or non-finite components, and rows without id, take no
part; rows that repeat id and vector count once; vectors of different length never meet; ties go to the
smaller id; fewer candidates than k give fewer rows; an empty table gives an empty result. Scores must
fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.operators.joins import checked_broadcast
from tickloom.session import store

K = 5
SCALE = 256
PIVOTS = 64
SAMPLE = 2048
BLOCK = 4096
QUERY_BLOCK = 2048
LEAF = 64
FAN = 16
EXACT_DOUBLE = 2.0**53
SLACK = 0.25  # scores are whole numbers; bounds are doubles,
ROUNDING = 1e-12  # which are off by this share of the product of the norms at most
LOWEST = -(1 << 63)


def whole_vectors(rows: DataFrame, id_col: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: usable vectors with whole components."""
    x = F.col(vector)
    broken = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = F.col(id_col).isNotNull() & x.isNotNull() & ~broken
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return rows.filter(usable).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v")).distinct()


def _matrix(rows: pd.Series) -> np.ndarray:
    if not len(rows):
        return np.zeros((0, 0), dtype=np.int64)
    return np.array([np.asarray(r, dtype=np.int64) for r in rows], dtype=np.int64).reshape(len(rows), -1)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: by doubles where no sum can leave their exact range."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    top = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if top < EXACT_DOUBLE:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def farthest_first(points: np.ndarray, most: int, reach: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of centres (the first is point 0), each point's centre and its distance to it: picks the
    point farthest from all centres until none is farther than ``reach`` or there are ``most``."""
    centres = [0]
    nearest = np.linalg.norm(points - points[0], axis=1)
    owner = np.zeros(len(points), dtype=np.int64)
    while len(centres) < most:
        far = int(nearest.argmax())
        if nearest[far] <= reach:
            break
        distance = np.linalg.norm(points - points[far], axis=1)
        closer = distance < nearest
        owner[closer] = len(centres)
        nearest[closer] = distance[closer]
        centres.append(far)
    return np.array(centres), owner, nearest


class Node:
    """Rows under a centre within a covering radius; children cover half the radius where a net of
    ``FAN`` centres can, and as much as it can where not."""

    __slots__ = ("rows", "centre", "radius", "norm", "children", "worst")

    def __init__(self, points: np.ndarray, rows: np.ndarray) -> None:
        self.rows = rows
        self.centre = points[rows[0]]
        own = points[rows]
        self.radius = float(np.linalg.norm(own - self.centre, axis=1).max())
        self.norm = float(np.linalg.norm(self.centre))
        self.children: list[Node] = []
        self.worst = -np.inf
        if len(rows) > LEAF and self.radius > 0:
            centres, owner, _ = farthest_first(own, FAN, self.radius / 2)
            for at, centre in enumerate(centres):
                members = np.flatnonzero(owner == at)
                first = members[members != centre]
                self.children.append(Node(points, rows[np.concatenate([[centre], first])]))


def slack(a: Node, b: Node) -> float:
    """More than the rounding of ``bound`` and of a score that it is compared with."""
    return SLACK + ROUNDING * (a.norm + a.radius) * (b.norm + b.radius)


def bound(a: Node, b: Node) -> float:
    return float(a.centre @ b.centre) + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius


class Search:
    """The k best of one block of vectors for each query of one block."""

    def __init__(self, q_ids, queries, floor, v_ids, vectors, k: int) -> None:
        self.q_ids, self.queries, self.v_ids, self.vectors, self.k = q_ids, queries, v_ids, vectors, k
        self.kth = floor.astype(np.int64)
        self.best: list[list[tuple[int, int]]] = [[] for _ in q_ids]
        if len(q_ids) and len(v_ids):
            self.walk(Node(queries.astype(np.float64), np.arange(len(q_ids))), Node(vectors.astype(np.float64), np.arange(len(v_ids))))

    def walk(self, q: Node, v: Node) -> None:
        q.worst = int(self.kth[q.rows].min())
        if bound(q, v) + slack(q, v) < q.worst:
            return
        if not q.children and not v.children:
            self.base(q, v)
        elif v.children and (not q.children or v.radius >= q.radius):
            for child in sorted(v.children, key=lambda c: -bound(q, c)):
                self.walk(q, child)
        else:
            for child in q.children:
                self.walk(child, v)

    def base(self, q: Node, v: Node) -> None:
        found = scores(self.queries[q.rows], self.vectors[v.rows])
        ids = self.v_ids[v.rows]
        for row, line in zip(q.rows.tolist(), found, strict=True):
            take = np.flatnonzero((line >= self.kth[row]) & (ids != self.q_ids[row]))
            if not len(take):
                continue
            if len(take) > self.k:
                take = take[np.lexsort((ids[take], -line[take]))[: self.k]]
            merged = self.best[row] + [(-int(line[i]), int(ids[i])) for i in take]
            merged.sort()
            self.best[row] = merged[: self.k]
            if len(merged) >= self.k:
                self.kth[row] = max(self.kth[row], -merged[self.k - 1][0])


def _searcher(k: int):
    """Streams groups (query block, cell, cut), which arrive sorted with the queries first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found(rows: pd.DataFrame) -> pd.DataFrame:
            q, v = rows[rows["side"] == 0], rows[rows["side"] == 1]
            search = Search(
                q["vec_id"].to_numpy(), _matrix(q["v"]), q["floor"].to_numpy(), v["vec_id"].to_numpy(), _matrix(v["v"]), k
            )
            out = [(query, vec, -minus) for query, best in zip(search.q_ids.tolist(), search.best, strict=True) for minus, vec in best]
            return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

        held: list[pd.DataFrame] = []
        key = None
        for batch in batches:
            for at, rows in batch.groupby(["block", "dim", "cell", "cut"], sort=False):
                if at != key and held:
                    yield found(pd.concat(held, ignore_index=True))
                    held = []
                key = at
                held.append(rows)
        if held:
            yield found(pd.concat(held, ignore_index=True))

    return run


def _top_level(vectors: DataFrame, pivots: int, sample: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length of vector: pivots, and ids and vectors of the bounded sample."""
    taken = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas()
    tops = {}
    for dim, rows in taken.groupby(taken["v"].map(len)):
        points = _matrix(rows["v"])
        centres, _, _ = farthest_first(points.astype(np.float64), pivots)
        tops[int(dim)] = (points[centres], rows["vec_id"].to_numpy(), points)
    return tops


def _celled(vectors: DataFrame, tops: dict) -> DataFrame:
    """Add length, nearest pivot and the distance to it. Lengths that the sample lacks are one cell."""

    @F.pandas_udf("dim int, cell int, reach double")
    def of(rows: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"dim": rows.map(len).astype("int32"), "cell": np.int32(0), "reach": 0.0})
        for dim, at in out.groupby("dim").groups.items():
            points = _matrix(rows.loc[at]).astype(np.float64)
            pivots = tops[dim][0].astype(np.float64) if dim in tops else np.zeros((1, dim))
            # |x - p|^2 without |x|^2, which is the same for all pivots
            owner = ((pivots**2).sum(axis=1)[None, :] - 2 * (points @ pivots.T)).argmin(axis=1)
            out.loc[at, "cell"] = owner.astype("int32")
            out.loc[at, "reach"] = np.linalg.norm(points - pivots[owner], axis=1)
        return out

    return vectors.withColumn("_c", of("v")).select("vec_id", "v", "_c.*")


def _planned(queries: DataFrame, tops: dict, radii: dict, k: int) -> DataFrame:
    """Add ``floor``, the k-th score within the sample, and ``cells``, those that can hold a better one."""

    @F.pandas_udf("floor long, cells array<int>")
    def of(ids: pd.Series, rows: pd.Series) -> pd.DataFrame:
        floors = np.full(len(rows), LOWEST, dtype=np.int64)
        cells: list = [None] * len(rows)
        lengths = rows.map(len)
        for dim in lengths.unique():
            at = np.flatnonzero((lengths == dim).to_numpy())
            q = _matrix(rows.iloc[at])
            pivots = np.zeros((1, dim))
            if dim in tops:
                pivots, sample_ids, sample = tops[dim]
                got = scores(q, sample)
                got[ids.iloc[at].to_numpy()[:, None] == sample_ids[None, :]] = LOWEST
                if got.shape[1] >= k:
                    floors[at] = np.sort(got, axis=1)[:, -k]
            known = {c: r for (d, c), r in radii.items() if d == dim}
            names = np.array(sorted(known), dtype=np.int64)
            reach = np.array([known[c] for c in names.tolist()])
            norms = np.linalg.norm(q.astype(np.float64), axis=1)
            centres = pivots[names].astype(np.float64)
            most = q.astype(np.float64) @ centres.T + norms[:, None] * reach[None, :]
            most += SLACK + ROUNDING * norms[:, None] * (np.linalg.norm(centres, axis=1) + reach)[None, :]
            for i, line in zip(at.tolist(), most, strict=True):
                cells[i] = names[line >= float(floors[i])].astype("int32")
        return pd.DataFrame({"floor": floors, "cells": cells})

    return queries.withColumn("_p", of("vec_id", "v")).select("vec_id", "v", "dim", "cell", "_p.*")


def top_products(
    rows: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    scale: int = SCALE,
    pivots: int = PIVOTS,
    sample: int = SAMPLE,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest inner products of each query row (``is_query`` is
    a condition on ``vec_id``) with all other rows."""
    vectors = store(whole_vectors(rows, id_col, vector, scale), "vectors")
    tops = _top_level(vectors, pivots, sample)
    celled = store(_celled(vectors, tops), "cells")
    # One row for each pivot and length.
    sizes = celled.groupBy("dim", "cell").agg(
        F.max("reach").alias("reach"), F.count("*").alias("n"), F.sum(is_query.cast("long")).alias("queries")
    )
    known = sizes.orderBy("dim", "cell").collect()
    radii = {(r["dim"], r["cell"]): r["reach"] for r in known}
    starts, at = {}, 0
    for r in known:
        starts[r["dim"], r["cell"]] = (at, max(r["queries"], 1))
        at += r["queries"]
    schema = "dim int, cell int, start long, n_queries long, cuts long"
    spark = rows.sparkSession
    table = spark.createDataFrame(
        [(*key, *starts[key], -(-r["n"] // block)) for key, r in zip(starts, known, strict=True)], schema
    )
    table = F.broadcast(table)  # at most one row for each pivot and length of vector
    slot = F.pmod(F.xxhash64("vec_id"), F.col("n_queries"))
    queries = store(
        _planned(celled.filter(is_query), tops, radii, k)
        .join(table, ["dim", "cell"])
        .select("vec_id", "v", "dim", "floor", "cells", F.floor((F.col("start") + slot) / query_block).alias("block")),
        "queries",
    )
    group = ["block", "dim", "cell", "cut"]
    wanted = queries.select("block", "dim", F.explode("cells").alias("cell")).distinct()
    asked = wanted.groupBy("dim", "cell").agg(F.collect_list("block").alias("blocks"))
    cut = F.pmod(F.xxhash64("vec_id"), F.col("cuts"))
    data = (
        celled.join(table, ["dim", "cell"])
        .join(checked_broadcast(store(asked, "asked")), ["dim", "cell"])
        .select(F.explode("blocks").alias("block"), "dim", "cell", cut.alias("cut"), F.lit(1).alias("side"), "vec_id", "v", F.lit(0).cast("long").alias("floor"))
    )
    asking = (
        queries.select("block", "dim", F.explode("cells").alias("cell"), "vec_id", "v", "floor")
        .join(table, ["dim", "cell"])
        .select("block", "dim", "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)).alias("cut"), F.lit(0).alias("side"), "vec_id", "v", "floor")
    )
    dealt = data.unionByName(asking).repartition(*group).sortWithinPartitions(*group, "side")
    found = dealt.mapInPandas(_searcher(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
