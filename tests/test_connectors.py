"""Connectors are not installed here: what can be checked is that the code gets as far as asking Spark
for them."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark.errors import AnalysisException

from tickloom.functions.layouts import TRADE
from tickloom.session import build_session, run_folder, shared_root
from tickloom.sources import records, sinks

ROWS = "key string, value string, stock_code string, report_date date"


def test_kafka_sources_ask_for_the_connector(spark):
    for read in (records.trade_records, records.raw_records):
        with pytest.raises(AnalysisException, match="(?i)kafka"):
            read(spark, "broker:9092", [" H0STCNT0 ", "H0STASP0"], maxOffsetsPerTrigger="1000")


def test_kafka_and_index_sinks_ask_for_the_connector(spark):
    rows = spark.createDataFrame([], ROWS)
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        sinks.kafka_sink("broker:9092", "anomalies")(rows, 0)
    with pytest.raises(Exception, match="(?i)elasticsearch"):
        sinks.index_sink(sinks.REPORT_INDEX, **{"es.nodes": "host", "es.port": "9200"})(rows, 0)


def test_keyed_stream_asks_for_the_connector(spark, tmp_path):
    rows = spark.readStream.format("rate").load().selectExpr(
        f"'{TRADE.tr_id}' AS topic", "'005930' AS key", "'{{}}' AS value"
    )
    writer = sinks.keyed_kafka_writer(rows, "broker:9092", str(tmp_path))
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        writer.start()


def test_shared_folder_comes_from_the_session(spark):
    root = shared_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert run_folder(spark, "x").startswith(root + "/x-") and run_folder(spark, "x") != run_folder(spark, "x")


def test_session_settings(spark):
    session = build_session(zone="Asia/Seoul", spark__sql__files__maxPartitionBytes="64m")
    assert session.conf.get("spark.sql.session.timeZone") == "Asia/Seoul"
    assert session.conf.get("spark.sql.files.maxPartitionBytes") == "64m"
    session.conf.unset("spark.sql.files.maxPartitionBytes")


def test_without_a_shared_folder_the_error_says_what_to_set(tmp_path):
    """In a process of its own: a session that names no folder, then one set in the supported way."""
    code = f"""
from pyspark.sql import SparkSession
from tickloom.session import shared_root, store
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
try:
    shared_root(spark)
except ValueError as error:
    print("said", "spark.checkpoint.dir" in str(error))
spark.conf.set("spark.tickloom.shared", "{tmp_path}")
print("rows", store(spark.range(3), "x").count())
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", code], capture_output=True, text=True, env=os.environ | {"PYTHONPATH": root, "SPARK_CONF_DIR": str(tmp_path)}, timeout=200
    )
    assert "said True" in done.stdout and "rows 3" in done.stdout, done.stderr[-2000:]


def test_document_ids_tell_rows_apart_and_repeat(spark):
    rows = spark.createDataFrame(
        [("t", "1", None, "n", 1), ("t", "1", "n", None, 1), ("t", "1", None, "n", 2)],
        "update_time string, stock_code string, sector string, name string, total_volume long",
    )
    ids = [r.document_id for r in sinks.with_document_id(rows).collect()]
    assert ids[0] == ids[2] != ids[1]
    parts = sinks.with_document_id(rows.withColumn("part", rows["total_volume"]))
    assert parts.select("document_id").distinct().count() == 3
