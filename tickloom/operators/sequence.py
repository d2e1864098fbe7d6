"""The order of published messages: a number per key that goes on from batch to batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.joins import checked_broadcast

# Where a record stood in the source.
SOURCE = ("partition", "offset", "record_no")
KEY = ("topic", "key")
#: One row per topic, key and source partition: the last place seen and the messages of the key so far.
STATE = "topic string, key string, partition int, last_offset bigint, last_record_no int, sequence bigint"
# Offsets in a bucket: 2 to the power of this.
BUCKET = 16
# What rows are numbered in, as columns and as one text: rows that lie by one column stay where they are
# in all steps after, while a join that has to respect NULLs in several would move them again.
GROUP = (*KEY, "partition", "_bucket")
GROUP_TEXT = "_group"


def _same(a: str, b: str, names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(f"{a}.{name}").eqNullSafe(F.col(f"{b}.{name}"))
    return condition


def fresh_rows(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Rows that were not there before: beyond the last place of their key and partition, each place once.

    A source gives the records of one partition in the order of their offsets, so a place at or before the last
    one is a repeat, whichever batch it comes in. ``state`` is measured and broadcast while it is small: keys
    are stocks.
    """
    joined = rows.alias("r").join(checked_broadcast(state).alias("s"), _same("r", "s", (*KEY, "partition")), "left")
    offset, last = F.col("r.offset"), F.col("s.last_offset")
    beyond = last.isNull() | (offset > last) | ((offset == last) & (F.col("r.record_no") > F.col("s.last_record_no")))
    bucketed = joined.filter(beyond).select("r.*", F.shiftright(F.col("r.offset"), BUCKET).alias("_bucket"))
    bucketed = bucketed.withColumn(GROUP_TEXT, F.to_json(F.struct(*GROUP), {"ignoreNullFields": "false"}))
    inside = Window.partitionBy(GROUP_TEXT).orderBy("offset", "record_no")
    place = F.struct("offset", "record_no")
    # No two records have one place, so what comes second is a repeat.
    first = F.coalesce(place != F.lag(place).over(inside), F.lit(True))
    return bucketed.withColumn("_first", first).filter("_first").drop("_first")


def with_sequence(fresh: DataFrame, state: DataFrame) -> DataFrame:
    """Add ``sequence``: 1, 2, ... within each (topic, key), by place in the source, going on from ``state``.

    ``fresh`` comes from :func:`fresh_rows` and should be cached: then its rows are not shuffled again, only the
    counts are. Rows are numbered within buckets of offsets and the counts of buckets are added up, so no task
    sorts all messages of one key. NULL keys are one key.
    """
    counts = fresh.groupBy(GROUP_TEXT, *GROUP).agg(F.count("*").alias("_n"))
    so_far = state.groupBy(*KEY).agg(F.max("sequence").alias("_so_far"))
    earlier = Window.partitionBy(*KEY).orderBy("partition", "_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    based = before.alias("b").join(so_far.alias("f"), _same("b", "f", KEY), "left")
    based = based.select(f"b.{GROUP_TEXT}", (F.coalesce("f._so_far", F.lit(0)) + F.col("b._before")).alias("_base"))
    inside = Window.partitionBy(GROUP_TEXT).orderBy("offset", "record_no")
    numbered = fresh.withColumn("_inside", F.row_number().over(inside))
    placed = numbered.join(based, GROUP_TEXT).withColumn("sequence", (F.col("_base") + F.col("_inside")).cast("long"))
    return placed.drop(GROUP_TEXT, "_bucket", "_inside", "_base")


def next_state(fresh: DataFrame, state: DataFrame) -> DataFrame:
    """The state after these rows: one row per topic, key and source partition."""
    place = F.max(F.struct("offset", "record_no"))
    seen = fresh.groupBy(*KEY, "partition").agg(place.alias("at"), F.count("*").alias("n"))
    merged = (
        seen.select(*KEY, "partition", F.col("at.offset").alias("last_offset"), F.col("at.record_no").alias("last_record_no"), "n")
        .withColumn("sequence", F.lit(0).cast("long"))
        .unionByName(state.withColumn("n", F.lit(0).cast("long")))
    )
    # The old row of a partition is beaten by the new place; the number is that of the key.
    latest = merged.groupBy(*KEY, "partition").agg(F.max(F.struct("last_offset", "last_record_no")).alias("at"))
    totals = merged.groupBy(*KEY).agg((F.max("sequence") + F.sum("n")).alias("sequence"))
    joined = latest.alias("l").join(totals.alias("t"), _same("l", "t", KEY))
    return joined.select("l.topic", "l.key", "l.partition", "l.at.last_offset", "l.at.last_record_no", "t.sequence")
