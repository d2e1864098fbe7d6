"""Joins of a large table with one that is small as a rule: broadcast if it really is, else by shuffle
with hot keys cut into slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT = 64 * 1024 * 1024
ROWS_PER_SLICE = 5_000_000


def is_small(rows: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """Whether the rows, measured as text, stay below ``limit`` bytes. This runs an aggregate over
    them, so they should come from a file or a stored result."""
    row_bytes = F.octet_length(F.to_json(F.struct("*")))
    return (rows.agg(F.sum(row_bytes)).first()[0] or 0) <= limit


def checked_broadcast(rows: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only if the measured size stays below the limit."""
    return F.broadcast(rows) if is_small(rows, limit) else rows


def sliced_left_join(
    rows: DataFrame,
    other: DataFrame,
    key: str,
    spread_on: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Left join by shuffle where single keys may hold a large part of ``rows``.

    Keys with more than ``rows_per_slice`` rows, NULL included, are cut into slices by a hash of the
    ``spread_on`` columns, and only their rows of ``other`` are repeated per slice. The list of such
    keys has at most one entry per ``rows_per_slice`` rows (200,000 for 10^12 rows), which bounds its
    broadcast.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("_rows"))
    hot = counts.filter(F.col("_rows") > rows_per_slice).select(
        F.col(key).alias("_hot"),
        F.ceil(F.col("_rows") / rows_per_slice).cast("int").alias("_slices"),
    )
    slices = F.coalesce(F.col("_slices"), F.lit(1))
    sliced_rows = rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot")), "left").select(
        *rows.columns, F.pmod(F.xxhash64(*spread_on), slices).cast("int").alias("_slice")
    )
    sliced_other = other.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").select(
        *other.columns, F.explode(F.sequence(F.lit(0), slices - 1)).alias("_slice")
    )
    return sliced_rows.join(sliced_other, [key, "_slice"], "left").drop("_slice")
