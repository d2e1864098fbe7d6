"""Sinks of the market report. A sink is a function ``(rows, batch_id) -> None``.

The Kafka and search-index sinks need their connector packages on the cluster; the table sink needs
nothing but Spark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

Sink = Callable[[DataFrame, int], None]

# Delivery settings of the keyed trade sink.
KAFKA_DELIVERY = {"kafka.acks": "all", "kafka.retries": "5"}
# Index names (one index per day) and field types.
REPORT_INDEX = "stock_report_agg_{report_date}"
ANOMALY_INDEX = "stock_report_anomal_{report_date}"
INDEX_FIELDS = {
    "es.mapping.properties.name": "keyword",
    "es.mapping.properties.update_time": "date",
    "es.mapping.exclude": "report_date,document_id",
}
# Connection settings of the index.
INDEX_CONNECTION = {
    "es.net.ssl": "true",
    "es.nodes.wan.only": "true",
    "es.nodes.discovery": "false",
}


def table_sink(path: str) -> Sink:
    """Parquet by ``report_date`` and batch. A replayed batch overwrites just its own folders, so
    nothing is written twice. Rebalancing lets Spark merge small pieces of a day and split large
    ones, in place of one file per task and day."""

    def write(rows: DataFrame, batch_id: int) -> None:
        (
            rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
            .hint("rebalance", "report_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("report_date", "batch_id")
            .parquet(path)
        )

    return write


# What tells documents of one index apart; a redone batch writes the same ones again.
INDEX_KEYS = ("update_time", "stock_code", "sector", "name", "part")
INDEX_WRITE = {"es.mapping.id": "document_id", "es.write.operation": "upsert"}


def with_document_id(rows: DataFrame) -> DataFrame:
    """Add ``document_id``, made of the keys that the rows have. NULLs count as values."""
    keys = [name for name in INDEX_KEYS if name in rows.columns]
    text = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    return rows.withColumn("document_id", F.sha2(text, 256))


def index_sink(index: str, **options: str) -> Sink:
    """A search index per report day. ``options`` hold host, port and credentials. Documents have ids of
    their own, so a repeated batch overwrites what it wrote before."""

    def write(rows: DataFrame, batch_id: int) -> None:
        (
            with_document_id(rows.withColumn("report_date", F.col("report_date").cast("string")))
            .write.format("org.elasticsearch.spark.sql")
            .mode("append")
            .options(**INDEX_CONNECTION, **INDEX_FIELDS, **INDEX_WRITE)
            .options(**options)
            .option("es.resource", index)
            .save()
        )

    return write


def kafka_sink(servers: str, topic: str, **options: str) -> Sink:
    """Rows ``key, value`` to one topic."""

    def write(rows: DataFrame, batch_id: int) -> None:
        (
            rows.select("key", "value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .options(**options)
            .save()
        )

    return write


def keyed_kafka_writer(rows: DataFrame, servers: str, checkpoint: str, **options: str) -> DataStreamWriter:
    """Stream ``topic, key, value`` rows to the topic each row names, acknowledged by all replicas."""
    return (
        rows.writeStream.format("kafka")
        .outputMode("append")
        .option("kafka.bootstrap.servers", servers)
        .options(**KAFKA_DELIVERY)
        .options(**options)
        .option("checkpointLocation", checkpoint)
    )
