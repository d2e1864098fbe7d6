"""Connected components of a distributed edge list: alternating large-star and small-star rounds.

Every round is a handful of joins and partial aggregations over the edges. Its result is written to
the shared folder, so the lineage stays short and a lost executor costs one round at most. A node with very
many neighbours, as the centre of a star of near copies, is cut into slices. Nothing but a count and a checksum
of the edges reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.skew import ROWS_PER_SLICE, lookup
from tickloom.session import store


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge set."""
    check = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), check).first())


def _with_least(edges: DataFrame, rows_per_slice: int) -> DataFrame:
    """``u, v, m``: each edge with the smallest neighbour of ``u``, nodes of many edges in slices."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    return lookup(edges, least, "u", "n", ["v"], "inner", rows_per_slice)


def _large_star(edges: DataFrame, rows_per_slice: int) -> DataFrame:
    """Links the larger neighbours of each node to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    met = _with_least(both, rows_per_slice).filter("v > u")
    return met.select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame, rows_per_slice: int) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them. Edges have ``u > v``."""
    met = _with_least(edges, rows_per_slice)
    # The smallest neighbour's own edge gives the node's link, the others give theirs.
    return met.select(F.when(F.col("v") > F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v")).distinct()


def components(links: DataFrame, a: str, b: str, name: str = "components", rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """``node, root`` for every node that is linked to another; ``root`` is the smallest node that
    can be reached. Links to itself, repeated links and NULL ends are ignored; no links, no rows."""
    edges = store(
        links.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        name,
    )
    before = _mark(edges)
    while before[0]:
        edges = store(_small_star(_large_star(edges, rows_per_slice), rows_per_slice), name)
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
