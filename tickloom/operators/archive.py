"""Raw records as archive documents, and counts per topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.clock import local_day, local_text

ZONE = "Asia/Seoul"


def archive_rows(records: DataFrame, insert_time: Column | None = None, zone: str = ZONE) -> DataFrame:
    """The record unchanged, where it came from, and when it was archived.

    ``topic`` and ``insert_day`` repeat known values as partition columns of the table.
    """
    inserted = F.current_timestamp() if insert_time is None else insert_time
    return records.select(
        F.col("value").cast("string").alias("raw_data"),
        F.struct(
            "topic", "partition", "offset", F.col("key").cast("string").alias("key")
        ).alias("metadata"),
        F.col("timestamp").cast("timestamp").alias("kafka_timestamp"),
        inserted.alias("insert_time"),
        local_text(inserted, zone).alias("insert_date"),
        "topic",
        local_day(inserted, zone).alias("insert_day"),
    )


def kafka_millis(records: DataFrame, millis_col: str) -> DataFrame:
    """Records whose time is given in epoch milliseconds, with a ``timestamp`` column."""
    return records.withColumn("timestamp", F.timestamp_millis(F.col(millis_col)))


def archive_counts(documents: DataFrame) -> DataFrame:
    """Documents per topic."""
    return documents.groupBy("topic").agg(F.count("*").alias("documents"))
