"""Feeds: Kafka topics or, with the same columns, files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of Spark's Kafka source.
RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def _kafka(spark: SparkSession, servers: str, topics: Sequence[str], options: dict) -> DataFrame:
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topic.strip() for topic in topics))
    )
    return reader.options(**options).load()


def trade_records(spark: SparkSession, servers: str, topics: Sequence[str], **options) -> DataFrame:
    """Trade topics from now on; lost offsets do not end the stream."""
    return _kafka(spark, servers, topics, {"failOnDataLoss": "false", **options})


def raw_records(spark: SparkSession, servers: str, topics: Sequence[str], **options) -> DataFrame:
    """All given topics from their earliest offset, for the archive."""
    return _kafka(spark, servers, topics, {"startingOffsets": "earliest", **options})


def record_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """A stream of Parquet files that hold Kafka-shaped records."""
    return spark.readStream.schema(RECORD).options(**options).parquet(path)


def frame_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """A stream of text files, one raw frame per line."""
    return spark.readStream.options(**options).text(path).withColumnRenamed("value", "frame")


def frames_of(records: DataFrame) -> DataFrame:
    """Kafka records whose value is a raw frame."""
    return records.withColumn("frame", F.col("value").cast("string"))
