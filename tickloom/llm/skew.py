"""Joins of rows with one row per key, where a key may hold a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_SLICE = 100_000


def lookup(
    rows: DataFrame,
    groups: DataFrame,
    key: str | Sequence[str],
    count: str,
    spread_on: Sequence[str],
    how: str = "left",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Join ``rows`` with ``groups`` (``key``, one column or several, unique, ``count`` the number of rows that have it).

    Keys of more than ``rows_per_slice`` rows are cut into slices by a hash of ``spread_on``; their row
    of ``groups`` is repeated for each slice. There is at most one such key per ``rows_per_slice`` rows,
    which bounds the list of them that is broadcast.
    """
    keys = [key] if isinstance(key, str) else [*key]
    cuts = F.ceil(F.col(count) / rows_per_slice).cast("int")
    hot = F.broadcast(groups.filter(F.col(count) > rows_per_slice).select(*keys, cuts.alias("_cuts")))
    one = F.coalesce(F.col("_cuts"), F.lit(1))
    sliced = rows.join(hot, keys, "left").withColumn("_slice", F.pmod(F.xxhash64(*spread_on), one)).drop("_cuts")
    repeated = groups.withColumn(
        "_slice", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(cuts, F.lit(1)).cast("long") - 1))
    )
    return sliced.join(repeated, [*keys, "_slice"], how).drop("_slice")
