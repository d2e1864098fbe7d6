"""The archive table: Parquet, partitioned by topic and day of arrival, with closed days in larger files.

A stream writes small files. Closed days are copied into a second place, and a list of copied days says from
which place a day is read. A day changes over when its entry in the list is written, one small file, after
all of its data; until then, and if a copy fails, readers take it where it was. The stream goes on all the while.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.clock import local_day
from tickloom.operators.archive import ZONE
from tickloom.operators.trades import parse_trades

PARTITIONS = ("topic", "insert_day")
SCHEMA = (
    "raw_data string, metadata struct<topic:string, partition:int, offset:bigint, key:string>, kafka_timestamp timestamp, "
    "insert_time timestamp, insert_date string, topic string, insert_day date"
)
# How long after it was sent a record may reach the archive.
LAG = "7 days"


def read_archive(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    """Archived documents; with ``topic`` only that topic's folders are read."""
    documents = spark.read.schema(SCHEMA).parquet(path)
    return documents if topic is None else documents.filter(F.col("topic") == topic)


def write_archive(documents: DataFrame, path: str) -> None:
    documents.write.mode("append").partitionBy(*PARTITIONS).parquet(path)


def compact_days(documents: DataFrame, target: str, before: Column) -> None:
    """Write the days before ``before`` anew into the table ``target``, in files of the size that Spark
    aims at instead of one per task and flush. A repeated run overwrites just these days."""
    (
        documents.filter(F.col("insert_day") < before)
        .hint("rebalance", *PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(target)
    )


# The list of copied days. A day that is copied again gets a higher version; the highest one counts.
DAYS = "insert_day date, version int, documents bigint"
COPIED = f"{SCHEMA}, version int"


def _copied(spark: SparkSession, compacted: str) -> DataFrame:
    return spark.read.schema(COPIED).parquet(f"{compacted}/data")


def copied_days(spark: SparkSession, compacted: str) -> DataFrame:
    """``insert_day, version, documents`` of the days that are read from the compacted place; one row per day."""
    try:
        entries = spark.read.schema(DAYS).parquet(f"{compacted}/days")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        entries = spark.createDataFrame([], DAYS)
    return entries.groupBy("insert_day").agg(F.max("version").alias("version"), F.max_by("documents", "version").alias("documents"))


def copy_days(spark: SparkSession, path: str, compacted: str, before: Column) -> DataFrame:
    """Copy the days before ``before`` that are not listed, or to which the stream has added since, and return their
    entries for the list. What the stream's folders no longer hold is left as it was copied."""
    raw = read_archive(spark, path).filter(F.col("insert_day") < before)
    there = raw.groupBy("insert_day").agg(F.count("*").alias("there"))
    wanted = there.join(copied_days(spark, compacted), "insert_day", "left").filter("documents is null or there > documents")
    # One row for each day.
    days = {r["insert_day"]: r["version"] for r in wanted.select("insert_day", (F.coalesce("version", F.lit(-1)) + 1).alias("version")).collect()}
    if not days:
        return spark.createDataFrame([], DAYS)
    versions = F.broadcast(spark.createDataFrame(list(days.items()), "insert_day date, version int"))
    rows = raw.filter(F.col("insert_day").isin(list(days))).join(versions, "insert_day")
    (
        rows.hint("rebalance", "version", *PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("version", *PARTITIONS)
        .parquet(f"{compacted}/data")
    )
    written = _copied(spark, compacted).filter(_on_days(days))
    return written.groupBy("insert_day", "version").agg(F.count("*").alias("documents")).select("insert_day", "version", "documents")


def list_days(entries: DataFrame, compacted: str) -> None:
    """From now on these days are read from the compacted place."""
    entries.coalesce(1).write.mode("append").parquet(f"{compacted}/days")


def compact_archive(spark: SparkSession, path: str, compacted: str, before: Column) -> None:
    """Copy closed days and change over to them. May be repeated at any time, also after a failure."""
    list_days(copy_days(spark, path, compacted, before), compacted)


def _on_days(days: dict) -> Column:
    """Documents of the given days in their versions; prunes folders."""
    found = F.lit(False)
    for version in sorted(set(days.values())):
        found = found | ((F.col("version") == version) & F.col("insert_day").isin([d for d, v in days.items() if v == version]))
    return found


def read_whole_archive(spark: SparkSession, path: str, compacted: str, topic: str | None = None) -> DataFrame:
    """The archive as one table: each day from exactly one place."""
    days = {r["insert_day"]: r["version"] for r in copied_days(spark, compacted).collect()}
    raw = read_archive(spark, path, topic)
    if not days:
        return raw
    done = _copied(spark, compacted).filter(_on_days(days)).drop("version")
    if topic is not None:
        done = done.filter(F.col("topic") == topic)
    return raw.filter(~F.col("insert_day").isin(list(days))).unionByName(done)


def archived_records(documents: DataFrame) -> DataFrame:
    """Documents back in the shape of Kafka records."""
    return documents.select(
        F.col("metadata.key").alias("key"),
        F.col("raw_data").alias("value"),
        "topic",
        "metadata.partition",
        "metadata.offset",
        F.col("kafka_timestamp").alias("timestamp"),
        "insert_day",
    )


def archived_trades(
    spark: SparkSession,
    path: str,
    topic: str,
    start: datetime,
    end: datetime,
    zone: str = ZONE,
    lag: str = LAG,
    compacted: str | None = None,
) -> DataFrame:
    """Parsed trades sent in ``[start, end)``. A record is archived after it was sent and within ``lag``,
    so only the folders of these days are read, in the place ``compacted`` too if it is given."""
    last = local_day(F.lit(end) + F.expr(f"interval {lag}"), zone)
    sent = F.col("timestamp")
    documents = read_archive(spark, path, topic) if compacted is None else read_whole_archive(spark, path, compacted, topic)
    records = archived_records(documents).filter(
        F.col("insert_day").between(local_day(F.lit(start), zone), last) & (sent >= F.lit(start)) & (sent < F.lit(end))
    )
    return parse_trades(records, keep=["partition", "offset"])
