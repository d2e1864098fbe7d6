"""Turns of conversations in their order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Turn numbers in one bucket: 2 to the power of this.
BUCKET = 10


def positions(rows: DataFrame, key: str, turn: str, ties: Sequence[str]) -> DataFrame:
    """Add ``at``: 1, 2, ... by ``turn`` within each ``key`` (never NULL), NULL first, then by ``ties``.

    Rows are sorted within buckets of turn numbers, and the counts of buckets give the places before
    them, so a conversation that holds a large part of all rows is spread over many tasks. Rows of one
    conversation with one and the same turn number are sorted in one task, in a streaming window.
    """
    # NULL has a bucket of its own, before all others: no bucket number is that low.
    bucketed = rows.withColumn("_bucket", F.coalesce(F.shiftright(turn, BUCKET), F.lit(-(1 << 62))))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = bucketed.groupBy(key, "_bucket").agg(F.count("*").alias("_n"))
    offsets = counts.select(key, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(key, "_bucket").orderBy(F.col(turn).asc_nulls_first(), *ties)
    numbered = bucketed.withColumn("_inside", F.row_number().over(inside))
    placed = numbered.join(offsets, [key, "_bucket"])
    return placed.withColumn("at", F.col("_before") + F.col("_inside")).drop("_bucket", "_inside", "_before")
