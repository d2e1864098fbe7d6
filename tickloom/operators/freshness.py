"""Is the archive still being fed? Latest record, lag and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.clock import local_day, local_text, seconds_between, start_of_local_day
from tickloom.operators.archive import ZONE

# Fixed value: seconds without a new document that count as a stall.
STALL_SECONDS = 300


def arrived_today(documents: DataFrame, now: Column | None = None, zone: str = ZONE) -> DataFrame:
    """Documents archived since the zone's midnight. The day bound prunes table partitions."""
    moment = F.current_timestamp() if now is None else now
    return documents.filter(
        (F.col("insert_day") >= local_day(moment, zone))
        & (F.col("insert_time") >= start_of_local_day(moment, zone))
    )


def latest_record(documents: DataFrame, now: Column | None = None, zone: str = ZONE) -> DataFrame:
    """The newest document of today. Ties go to the highest topic, partition and offset.

    Which one it is, is found from the narrow columns (this runs a job); its text is then fetched by a
    filter that reaches the scan, so the raw texts of the day are not read.
    """
    today = arrived_today(documents, now, zone)
    place = F.struct("insert_time", "metadata.topic", "metadata.partition", "metadata.offset")
    newest = today.agg(F.max(place).alias("at")).select("at.*").first()
    if newest["insert_time"] is None:
        return today.limit(0)
    found = F.col("insert_time") == F.lit(newest["insert_time"])
    for name in ("topic", "partition", "offset"):
        found = found & F.col(f"metadata.{name}").eqNullSafe(F.lit(newest[name]))
    return today.filter(found).limit(1)


def freshness(
    documents: DataFrame,
    topics: Sequence[str],
    now: Column | None = None,
    zone: str = ZONE,
    threshold: int = STALL_SECONDS,
) -> DataFrame:
    """Per topic: ``last_insert, checked_at, lag_seconds, healthy``.

    A topic is healthy if it has a document today and the newest one is younger than ``threshold``
    seconds. Topics without documents today are listed as unhealthy.
    """
    moment = F.current_timestamp() if now is None else now
    listed = F.explode(F.array(*[F.lit(topic) for topic in topics]))
    expected = documents.sparkSession.range(1).select(listed.alias("topic"))
    latest = (
        arrived_today(documents.filter(F.col("topic").isin(list(topics))), moment, zone)
        .groupBy("topic")
        .agg(F.max("insert_time").alias("last_insert"))
    )
    lag = seconds_between(F.col("last_insert"), moment)
    return (
        expected.join(latest, "topic", "left")
        .withColumns({"checked_at": moment, "lag_seconds": lag})
        .withColumn("healthy", F.coalesce(F.col("lag_seconds") < threshold, F.lit(False)))
    )


def alerts(checks: DataFrame, job: str, zone: str = ZONE) -> DataFrame:
    """One row per failed check: the job and its local run time."""
    return checks.filter(~F.col("healthy")).select(
        F.lit(job).alias("job"),
        "topic",
        local_text(F.col("checked_at"), zone).alias("run_time"),
        "lag_seconds",
    )
