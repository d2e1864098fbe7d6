from __future__ import annotations

from datetime import datetime, timedelta

import feed
import pytest
from pyspark.sql import functions as F

from tickloom.functions.clock import iso_text, start_of_local_day
from tickloom.operators import archive, freshness

NOW = datetime(2025, 7, 2, 15, 10, 0)  # 00:10 of July 3 in Seoul
MIDNIGHT = datetime(2025, 7, 2, 15, 0, 0)


def _now():
    return F.lit(NOW.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def _documents(spark, *ages, topic="A"):
    """Documents archived so many seconds before now."""
    rows = [feed.record("1", "x", 0, n, topic) + (NOW - timedelta(seconds=age),) for n, age in enumerate(ages)]
    from pyspark.sql import types as T

    from tickloom.sources.records import RECORD

    schema = T.StructType([*RECORD.fields, T.StructField("arrived", T.TimestampType())])
    return archive.archive_rows(spark.createDataFrame(rows, schema), F.col("arrived"))


def test_document(spark):
    row = _documents(spark, 700).first()
    assert row.raw_data == "x" and tuple(row.metadata) == ("A", 0, 0, "1")
    assert row.insert_date == "2025-07-02 23:58:20" and str(row.insert_day) == "2025-07-02"
    assert row.topic == "A"


def test_null_key_and_epoch_millis(spark):
    rows = feed.records(spark, [feed.record(None, "x", 0, 0)]).drop("timestamp")
    rows = archive.kafka_millis(rows.withColumn("ms", F.lit(1751414401123)), "ms")
    row = archive.archive_rows(rows).select("*", F.unix_millis("kafka_timestamp").alias("ms")).first()
    assert row.metadata["key"] is None and row.ms == 1751414401123


@pytest.mark.parametrize("zone", ["UTC", "Asia/Seoul", "America/New_York"])
def test_local_midnight_does_not_depend_on_the_session_zone(spark, zone):
    now = spark.range(1).select(F.timestamp_seconds(F.lit(1751469000)).alias("t"))  # 15:10 UTC
    spark.conf.set("spark.sql.session.timeZone", zone)
    start = now.select(F.unix_seconds(start_of_local_day(F.col("t"), "Asia/Seoul"))).first()[0]
    assert start == 1751468400
    assert iso_text(F.col("t")) is not None


@pytest.mark.parametrize(
    ("ages", "healthy", "lag"),
    [
        ((299.999,), True, 299.999),
        ((300,), False, 300.0),
        ((400, 20, 350), True, 20.0),
        ((601,), False, None),  # before local midnight: nothing today
        ((), False, None),
    ],
)
def test_freshness(spark, ages, healthy, lag):
    documents = _documents(spark, *ages) if ages else _documents(spark, 1).limit(0)
    row = freshness.freshness(documents, ["A"], _now()).first()
    assert (row.topic, row.healthy, row.lag_seconds) == ("A", healthy, lag)


def test_alerts_name_job_topic_and_local_time(spark):
    documents = _documents(spark, 10).union(_documents(spark, 400, topic="B"))
    checks = freshness.freshness(documents, ["A", "B", "C"], _now())
    rows = sorted(map(tuple, freshness.alerts(checks, "monitor").collect()))
    assert rows == [
        ("monitor", "B", "2025-07-03 00:10:00", 400.0),
        ("monitor", "C", "2025-07-03 00:10:00", None),
    ]


def test_latest_record_breaks_ties(spark):
    documents = _documents(spark, 50, 10, 10, 10, 700).union(_documents(spark, 10))
    row = freshness.latest_record(documents, _now()).first()
    assert row.metadata["offset"] == 3
    assert freshness.latest_record(_documents(spark, 700), _now()).count() == 0


def test_counts(spark):
    documents = _documents(spark, 1, 2, 3).union(_documents(spark, 1, topic="B"))
    assert sorted(map(tuple, archive.archive_counts(documents).collect())) == [("A", 3), ("B", 1)]
