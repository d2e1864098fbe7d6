"""What the plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tickloom.operators import archive, frames, freshness, sectors, trades, vwap
from tickloom.plans import market, tables
from tickloom.session import run_folder
from tickloom.sources.archive import read_archive, write_archive
from tickloom.sources.sectors import read_sectors


STREAMS = ("q11_vwap_stream", "q14_archive_stream", "q20_late_data", "q23_report_fanout", "q28_fanout_report", "q29_fanout_messages", "q33_frame_files")


def plan(rows) -> str:
    return rows._jdf.queryExecution().explainString(
        rows.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def read_schema(text: str, table: str) -> str:
    """The columns a scan of the table reads."""
    found = re.search(rf"{table}\.parquet\](?:.|\n)*?ReadSchema: struct<(.*?)>\n", text)
    return found.group(1)


@pytest.mark.parametrize("name", [q.__name__ for q in entry.QUERIES if q.__name__ not in STREAMS])
def test_no_python_no_cross_join_no_single_task_window(spark, small, name):
    text = plan(entry.queries()[name](spark, small))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert bad not in text


def test_day_filter_reaches_the_scan(spark, small):
    text = plan(entry.q07_day_filter(spark, small))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in text and "LessThan(ts,2024-01-16T00:00)" in text


def test_report_shuffles_sums_not_messages(spark, small):
    text = plan(entry.q10_vwap_batch(spark, small))
    assert "collect_list" not in text and "partial_try_sum" in text and "HashAggregate" in text
    assert read_schema(text, "orders") == "o_custkey:bigint,o_orderpriority:string"
    # Unused figures are pruned from the aggregate.
    assert "max(" not in text and "min(" not in text


def test_stored_records_are_read_without_ids(spark, small, tmp_path):
    tables.trade_records(tables.table(spark, small, "events")).write.parquet(f"{tmp_path}/records.parquet")
    records = spark.read.parquet(f"{tmp_path}/records.parquet")
    assert read_schema(plan(market.market_stats(records)), "records") == (
        "key:binary,value:binary,timestamp:timestamp_ntz"
    )


def test_messages_are_shuffled_for_anomalies_only(spark, small):
    """The stored windows are broadcast, and the trades meet them before any exchange."""
    text = plan(entry.q12_anomalies(spark, small))
    assert "BroadcastHashJoin Inner" in text and "slice" not in text
    # The scan of the trades is bounded by the time range of the anomalous windows.
    assert "GreaterThanOrEqual(ts," in text or "false" in text or "LocalTableScan" in text


def test_decoding_needs_no_shuffle(spark, small):
    feed = tables.mixed_frames(tables.table(spark, small, "events"))
    for rows in (frames.decode_trades(feed), frames.dead_letters(feed), frames.publish_rows(feed)):
        assert "Exchange" not in plan(rows)


def test_archive_reads_only_the_topic_and_day(spark, small):
    path = run_folder(spark, "plans")
    records = tables.topic_records(tables.table(spark, small, "events"))
    write_archive(archive.archive_rows(records, F.col("timestamp")), path)
    now = F.lit(entry.NOW).cast("timestamp")
    text = plan(freshness.freshness(read_archive(spark, path, "H0STCNT0"), ["H0STCNT0"], now))
    filters = re.search(r"PartitionFilters: (.*)", text).group(1)
    assert "H0STCNT0" in filters and "insert_day" in filters and "2024-01-31" in filters
    assert re.search(r"GreaterThanOrEqual\(insert_time,2024-01-30.15:00:00", text)
    top = plan(freshness.latest_record(read_archive(spark, path, "H0STCNT0"), now))
    assert re.search(r"PushedFilters: .*EqualTo\(insert_time,", top) and "Sort (" not in top


def test_no_method_is_too_large_to_compile(spark, small, capfd):
    """Generated code beyond 64 KB would be rejected and the stage would lose code generation."""
    feed = tables.mixed_frames(tables.table(spark, small, "events"))
    for rows in (frames.decode_trades(feed), frames.decode_orderbook(feed), frames.dead_letters(feed), frames.publish_rows(feed)):
        rows.write.format("noop").mode("overwrite").save()
    assert "Failed to compile" not in capfd.readouterr().err


def test_sector_join_of_a_report_is_a_broadcast(spark, small, tmp_path):
    (tmp_path / "s.json").write_text('[{"stock_code":"1","name":"one","sectors":["a"]}]')
    records = tables.trade_records(tables.table(spark, small, "events"))
    text = plan(market.vwap_report(records, read_sectors(spark, str(tmp_path / "s.json"))))
    assert "BroadcastHashJoin LeftOuter" in text


def test_trades_stay_in_place_for_a_small_dimension(spark, small):
    joined = plan(entry.q09_sector_join(spark, small))
    assert "BroadcastHashJoin LeftOuter" in joined and "hashpartitioning" not in joined


def test_large_dimension_is_joined_in_slices(spark, small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        parsed = trades.parse_trades(entry._records(spark, small), keep=market.IDS)
        dim = entry._dim(spark, small)
        joined = sectors.enrich_rows(parsed, dim, market.IDS, limit=0, rows_per_slice=5)
        assert re.search(r"hashpartitioning\(stock_code#\d+, _slice#\d+", plan(joined))
        assert joined.count() == sectors.enrich(parsed, dim).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_state_is_one_row_per_window_and_stock(spark, small, tmp_path):
    stream = trades.parse_trades(tables.trade_records(tables.events_stream(spark, small), "timestamp"))
    sums = vwap.window_sums(stream, "1 hour", vwap.LATENESS)
    query = (
        sums.writeStream.format("noop").outputMode("append")
        .option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    groups = vwap.window_sums(trades.parse_trades(entry._records(spark, small)), "1 hour").count()
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) == groups


def test_no_frame_is_built_or_read_by_interpreted_code(spark, small):
    """Spark interprets what a generator with a lambda works on: each of some hundred values of a frame."""
    events = tables.table(spark, small, "events")
    feeds = {frames.decode_trades: tables.trade_frames, frames.decode_orderbook: tables.orderbook_frames}
    for read, feed in feeds.items():
        assert not re.search(r"Arguments: (explode|inline)\w*\(.*lambdafunction", plan(read(feed(events))))
