"""Streaming writes to Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.archive import ZONE, archive_rows
from tickloom.sources.archive import PARTITIONS

# Fixed value: seconds between two archive flushes.
FLUSH_EVERY = "5 seconds"


def start_table(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append a stream to a table, exactly once (file sink with its own checkpoint)."""
    writer = rows.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(**(trigger or {"processingTime": "0 seconds"})).start(path)


def start_archive(
    records: DataFrame,
    path: str,
    checkpoint: str,
    insert_time: Column | None = None,
    zone: str = ZONE,
    trigger: dict | None = None,
    writers: int | None = None,
) -> StreamingQuery:
    """Archive every record. Batch size is a source option (``maxOffsetsPerTrigger`` for Kafka);
    the checkpoint takes the place of a flush at shutdown.

    Each task writes one file per topic and batch. Where that gives too many small files,
    ``writers`` brings the records of a batch together in that many tasks per topic; a large topic
    is thus spread over all of its writers.
    """
    rows = archive_rows(records, insert_time, zone)
    if writers is not None:
        writer = F.pmod(F.xxhash64("metadata.partition", "metadata.offset"), F.lit(writers))
        rows = rows.repartition("topic", writer)
    return start_table(rows, path, checkpoint, PARTITIONS, trigger or {"processingTime": FLUSH_EVERY})
