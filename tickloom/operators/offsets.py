"""Lost records: gaps in the offsets of an archive. Reading on after data loss does not fail, so it has to be
looked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Offsets in a bucket: 2 to the power of this.
BUCKET = 16
SOURCE = ("topic", "partition")


def source_offsets(documents: DataFrame) -> DataFrame:
    return documents.select("metadata.topic", "metadata.partition", "metadata.offset")


def islands(offsets: DataFrame) -> DataFrame:
    """Runs of consecutive offsets within buckets: ``topic, partition, bucket, first_offset, last_offset, records``
    (more than the run is long where offsets are archived twice).

    Rows are sorted within buckets of 65,536 offsets, so a partition with a large part of all records is
    spread over many tasks. Rows without an offset are left out."""
    known = offsets.filter("offset is not null").withColumn("bucket", F.shiftright("offset", BUCKET))
    counted = known.groupBy(*SOURCE, "bucket", "offset").agg(F.count("*").alias("copies"))
    inside = Window.partitionBy(*SOURCE, "bucket").orderBy("offset")
    run = F.col("offset") - F.row_number().over(inside)
    return (
        counted.withColumn("run", run)
        .groupBy(*SOURCE, "bucket", "run")
        .agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.sum("copies").alias("records"))
        .drop("run")
    )


def missing_offsets(offsets: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """``topic, partition, first_missing, last_missing, missing``: one row per gap between archived offsets.

    ``starts`` (``topic, partition, first_expected``) also finds what is missing before the first record, and
    partitions without any (``last_missing`` NULL). Offsets that a broker itself never hands out (of compacted
    topics and of transactions) look the same. Runs, not records, are compared over buckets: the run
    before is found within the bucket or, for the first run of a bucket, from the ends of buckets."""
    runs = islands(offsets)
    inside = Window.partitionBy(*SOURCE, "bucket").orderBy("first_offset")
    within = runs.withColumn("before", F.lag("last_offset").over(inside))
    gaps = within.filter("before is not null").select(*SOURCE, (F.col("before") + 1).alias("first_missing"), (F.col("first_offset") - 1).alias("last_missing"))
    # One row for each bucket.
    ends = runs.groupBy(*SOURCE, "bucket").agg(F.min("first_offset").alias("low"), F.max("last_offset").alias("high"))
    along = Window.partitionBy(*SOURCE).orderBy("bucket")
    between = ends.withColumn("before", F.lag("high").over(along)).filter("low > before + 1")
    gaps = gaps.unionByName(between.select(*SOURCE, (F.col("before") + 1).alias("first_missing"), (F.col("low") - 1).alias("last_missing")))
    if starts is not None:
        least = ends.groupBy(*SOURCE).agg(F.min("low").alias("low"))
        same = F.col("s.topic").eqNullSafe(F.col("l.topic")) & F.col("s.partition").eqNullSafe(F.col("l.partition"))
        late = starts.alias("s").join(least.alias("l"), same, "left").filter("l.low is null or l.low > s.first_expected")
        gaps = gaps.unionByName(late.select("s.topic", "s.partition", F.col("s.first_expected").alias("first_missing"), (F.col("l.low") - 1).alias("last_missing")))
    return gaps.withColumn("missing", F.col("last_missing") - F.col("first_missing") + 1)


def repeated_offsets(offsets: DataFrame) -> DataFrame:
    """``topic, partition, repeated``: records that are archived more often than once."""
    extra = F.col("records") - (F.col("last_offset") - F.col("first_offset") + 1)
    return islands(offsets).groupBy(*SOURCE).agg(F.sum(extra).alias("repeated")).filter("repeated > 0")
