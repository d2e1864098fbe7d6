"""

Every query runs over whole tables. ``events`` plays the trade feed, ``customer`` and ``orders`` the
sector dimension, ``pages`` the fetched sector pages (see ``tickloom.plans.tables``).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tickloom.functions.clock import local_text, trade_instant  # noqa: E402
from tickloom.functions.layouts import EXPECTED, ORDER_BOOK, TRADE, Layout  # noqa: E402
from tickloom.operators import archive, frames, freshness, joins, offsets, raw_schemas, sectors, trades, vwap  # noqa: E402
from tickloom.operators.raw_messages import with_messages  # noqa: E402
from tickloom.plans import market, reconcile, replay, tables  # noqa: E402
from tickloom.session import run_folder, store  # noqa: E402
from tickloom.sources.archive import (  # noqa: E402
    archived_trades,
    compact_archive,
    compact_days,
    copy_days,
    list_days,
    read_archive,
    read_whole_archive,
    write_archive,
)
from tickloom.sources.records import frame_files  # noqa: E402
from tickloom.sources.sectors import read_sector_history, read_sectors, write_sectors  # noqa: E402
from tickloom.sources.sinks import table_sink  # noqa: E402
from tickloom.streaming.market_report import (  # noqa: E402
    finish_anomalies,
    start_market_report,
    stream_breakdown,
    stream_stats,
)
from tickloom.streaming.publishing import start_publishing  # noqa: E402
from tickloom.streaming.tables import start_archive, start_table  # noqa: E402

# The corpus operators are an optional part, with packages of its own. Nothing else may be missing.
OPTIONAL = ("corpus_pipeline", "tickloom.llm", "ahocorasick", "numpy", "pandas", "public_tokenizers", "pyarrow", "sentencepiece", "tokenizers", "xxhash", "zstandard")

try:
    import corpus_pipeline
    from tickloom.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if not any(f"{missing.name}.".startswith(f"{name}.") for name in OPTIONAL):
        raise
    corpus_pipeline = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]

HOUR = "1 hour"
DAY = "2024-01-15"
NOW = "2024-01-30 23:59:00"
ONCE = {"availableNow": True}
HREF_AS_CODE = r"^(.+)$"
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # The SQL side knows no zones; event times are the same wall clock on both sides in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return tables.table(spark, folder, name)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "events")


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return tables.trade_records(_events(spark, folder))


def _entries(spark: SparkSession, folder: str) -> DataFrame:
    return tables.sector_entries(_read(spark, folder, "customer"), _read(spark, folder, "orders"))


def _dim(spark: SparkSession, folder: str) -> DataFrame:
    return sectors.sector_rows(_entries(spark, folder))


def _doubles(rows: DataFrame) -> DataFrame:
    """Decimals as doubles: the SQL side hands decimals out as doubles."""
    return rows.select(
        *[F.col(n).cast("double").alias(n) if t.startswith("decimal") else F.col(n) for n, t in rows.dtypes]
    )


# --- trades -------------------------------------------------------------------------------------


def q01_parse_json(spark: SparkSession, folder: str) -> DataFrame:
    parsed = trades.parse_trades(_records(spark, folder), keep=["offset"])
    return trades.trade_numbers(parsed).select(
        F.col("offset").alias("event_id"),
        "stock_code",
        "message_size_bytes",
        "original_message",
        "whole_price",
        "volume",
        F.col("data.acml_vol").alias("acml_vol"),
        F.col("data.cttr").alias("cttr"),
    )


def q36_today(spark: SparkSession, folder: str) -> DataFrame:
    """Records of today, found by the clock: the feed is moved by whole days so that its ``DAY`` is today."""
    today = F.current_date().cast("timestamp_ntz")
    shift = today - F.lit(DAY).cast("timestamp_ntz")
    moved = _records(spark, folder).withColumn("timestamp", F.col("timestamp") + shift)
    return trades.parse_trades(trades.on_day(moved), keep=["offset"]).select(
        F.col("offset").alias("event_id"), "stock_code", "original_message"
    )


def q07_day_filter(spark: SparkSession, folder: str) -> DataFrame:
    day = trades.on_day(_records(spark, folder), F.lit(DAY).cast("date"))
    return trades.parse_trades(day, keep=["offset"]).select(
        F.col("offset").alias("event_id"), "stock_code", "original_message"
    )


def q26_malformed_json(spark: SparkSession, folder: str) -> DataFrame:
    bad = trades.malformed_messages(tables.broken_records(_events(spark, folder)))
    return bad.select(F.col("offset").alias("event_id"), F.col("value").cast("string").alias("value"), "reason")


# --- frames -------------------------------------------------------------------------------------


def q02_decode_trades(spark: SparkSession, folder: str) -> DataFrame:
    feed = tables.trade_frames(_events(spark, folder))
    return _doubles(frames.decode_trades(feed, keep=["event_id", "record_no"]))


def q03_decode_expected(spark: SparkSession, folder: str) -> DataFrame:
    feed = tables.expected_frames(_events(spark, folder))
    return _doubles(frames.decode_expected(feed, keep=["event_id", "record_no"]))


def q04_decode_orderbook(spark: SparkSession, folder: str) -> DataFrame:
    feed = tables.orderbook_frames(_events(spark, folder))
    return _doubles(frames.decode_orderbook(feed, keep=["event_id", "record_no"]))


def q05_classify_frames(spark: SparkSession, folder: str) -> DataFrame:
    feed = tables.mixed_frames(_events(spark, folder))
    return frames.classify(feed).groupBy("event_type", "frame_class").agg(F.count("*").alias("frames"))


def q06_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    feed = tables.mixed_frames(_events(spark, folder))
    return frames.dead_letters(feed).select("event_id", "frame_no", "record_no", "reason", "frame")


def q22_publish_rows(spark: SparkSession, folder: str) -> DataFrame:
    return frames.publish_rows(tables.mixed_frames(_events(spark, folder)))


def q24_orderbook_levels(spark: SparkSession, folder: str) -> DataFrame:
    feed = tables.orderbook_frames(_events(spark, folder))
    levels = frames.orderbook_levels(frames.decode_orderbook(feed, keep=["event_id", "record_no"]))
    both = levels.select("event_id", "record_no", F.explode(F.arrays_zip("asks", "bids")).alias("at"))
    return _doubles(
        both.select(
            "event_id",
            "record_no",
            F.col("at.asks.level").alias("level"),
            F.col("at.asks.price").alias("ask_price"),
            F.col("at.asks.qty").alias("ask_qty"),
            F.col("at.bids.price").alias("bid_price"),
            F.col("at.bids.qty").alias("bid_qty"),
        )
    )


# --- sectors ------------------------------------------------------------------------------------


def q08_sector_explode(spark: SparkSession, folder: str) -> DataFrame:
    return _dim(spark, folder)


def q09_sector_join(spark: SparkSession, folder: str) -> DataFrame:
    parsed = trades.parse_trades(_records(spark, folder), keep=market.IDS)
    joined = sectors.enrich_rows(parsed, store(_dim(spark, folder), "q09"), spread_on=market.IDS)
    return joined.select(F.col("offset").alias("event_id"), "stock_code", "sector", "name", "message_size_bytes")


def q19_sector_map(spark: SparkSession, folder: str) -> DataFrame:
    links = sectors.sector_links(
        _read(spark, folder, "pages"),
        sector=F.col("url"),
        page_order=F.col("page_id"),
        html=F.col("html"),
        code_pattern=HREF_AS_CODE,
    )
    # Stored once: lists and names both need the links, and matching the pages is the costly part.
    return sectors.sector_map(store(links, "q19")).select(
        "stock_code", "name", F.array_join("sectors", " ").alias("sectors"), "part"
    )


def q21_sector_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    stats = market.market_stats(_records(spark, folder), HOUR)
    return vwap.sector_breakdown(sectors.enrich(stats, _dim(spark, folder)))


# --- report -------------------------------------------------------------------------------------


def q10_vwap_batch(spark: SparkSession, folder: str) -> DataFrame:
    return market.vwap_report(_records(spark, folder), _dim(spark, folder))


def _with_sorted_messages(rows: DataFrame) -> DataFrame:
    return rows.withColumn("raw_messages", F.sort_array("raw_messages"))


def _flat_anomalies(rows: DataFrame) -> DataFrame:
    """The message list as its size and one text, for comparison with SQL."""
    return _with_sorted_messages(rows).select(
        *vwap.ANOMALY_COLUMNS,
        F.size("raw_messages").cast("long").alias("messages"),
        F.array_join("raw_messages", "\n").alias("raw_messages"),
        "part",
        "parts",
        "messages_complete",
    )


def q12_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_anomalies(market.price_anomalies(_records(spark, folder), _dim(spark, folder), HOUR))


def q13_anomaly_envelope(spark: SparkSession, folder: str) -> DataFrame:
    rows = market.price_anomalies(_records(spark, folder), _dim(spark, folder), HOUR)
    return vwap.anomaly_messages(_with_sorted_messages(rows))


def q25_vwap_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.lineitem_trades(_read(spark, folder, "lineitem"))
    stats = vwap.window_stats(vwap.window_sums(rows, "1 day"))
    return stats.select(
        "update_time", "stock_code", "vwap", "total_volume", "min_price", "avg_price", "max_price"
    )


def q27_vwap_trade_clock(spark: SparkSession, folder: str) -> DataFrame:
    """VWAP timed by the trade's own clock in place of the broker's."""
    decoded = frames.decode_trades(tables.trade_frames(_events(spark, folder)))
    clock = trade_instant(F.col("bsop_date"), F.col("stck_cntg_hour"), "UTC")
    rows = trades.trades_from_decoded(decoded, clock)
    stats = vwap.window_stats(vwap.window_sums(rows))
    return vwap.report(sectors.enrich(stats, _dim(spark, folder)))


# --- streams ------------------------------------------------------------------------------------


def _trade_stream(spark: SparkSession, source: DataFrame) -> DataFrame:
    return trades.parse_trades(tables.trade_records(source, "timestamp"), keep=market.IDS)


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return tables.events_stream(spark, folder)


def q11_vwap_stream(spark: SparkSession, folder: str) -> DataFrame:
    out = run_folder(spark, "q11")
    dim = joins.checked_broadcast(store(_dim(spark, folder), "q11"))
    stats = stream_stats(_trade_stream(spark, _event_stream(spark, folder)), dim)
    rows = stats.select(*vwap.REPORT_COLUMNS, "report_date")
    start_table(rows, f"{out}/table", f"{out}/checkpoint", ("report_date",), ONCE).awaitTermination()
    return spark.read.parquet(f"{out}/table").select(*vwap.REPORT_COLUMNS)


def _fan_out(spark: SparkSession, folder: str, name: str) -> str:
    """One stream, three outputs; the messages come from the archive. Returns the folder of the tables."""
    out = run_folder(spark, name)
    archived = archive.archive_rows(tables.trade_records(_events(spark, folder), "timestamp"), _arrival())
    write_archive(archived, f"{out}/archive")
    start_market_report(
        _trade_stream(spark, _event_stream(spark, folder)),
        _dim(spark, folder),
        f"{out}/checkpoint",
        table_sink(f"{out}/report"),
        table_sink(f"{out}/anomalies"),
        table_sink(f"{out}/messages"),
        width=HOUR,
        archive=lambda start, end: archived_trades(spark, f"{out}/archive", TRADE.tr_id, start, end),
        trigger=ONCE,
    ).awaitTermination()
    return out


def q23_report_fanout(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_anomalies(spark.read.parquet(f"{_fan_out(spark, folder, 'q23')}/anomalies"))


def q28_fanout_report(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{_fan_out(spark, folder, 'q28')}/report").select(*vwap.REPORT_COLUMNS)


def q29_fanout_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Of the Kafka values, what does not depend on the order of messages."""
    rows = spark.read.parquet(f"{_fan_out(spark, folder, 'q29')}/messages")
    value = F.from_json("value", "update_time string, sector string, raw_messages array<string>, part int, parts int")
    return rows.select("key", value.alias("v")).select(
        "key", "v.update_time", "v.sector", F.array_join(F.sort_array("v.raw_messages"), "\n").alias("raw_messages"), "v.part", "v.parts"
    )


def q30_lagging_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Anomalies over an archive that lacks the messages of two event types out of five."""
    records = _records(spark, folder)
    stats = store(market.market_stats(records, HOUR), "q30")
    found = store(vwap.anomalies(stats), "q30-anomalies")
    some = tables.trade_records(_events(spark, folder).filter("event_type not in ('view', 'click')"))
    listed = with_messages(found, trades.parse_trades(some, keep=market.IDS), HOUR)
    return listed.select(
        "update_time", "stock_code", F.array_join(F.sort_array("raw_messages"), "\n").alias("raw_messages"), "messages_complete"
    )


def q31_batch_fanout(spark: SparkSession, folder: str) -> DataFrame:
    """Report and anomalies from one aggregate: report rows, marked where the window is an anomaly."""
    report, odd = market.report_and_anomalies(_records(spark, folder), _dim(spark, folder), HOUR)
    keys = ("update_time", "stock_code", "sector")
    marks = odd.select(*[F.col(k).alias(f"odd_{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"odd_{k}"))
    return report.join(marks, same, "left").select(*vwap.REPORT_COLUMNS, F.col("odd_update_time").isNotNull().alias("odd"))


def q20_late_data(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs over one checkpoint: error events arrive after all others were reported. Those of
    closed windows are dropped, the rest still counts."""
    out = run_folder(spark, "q20")
    events = _events(spark, folder)
    for late in (False, True):
        arriving = events.filter((F.col("event_type") == "error") == F.lit(late))
        arriving.write.mode("append").parquet(f"{out}/events")
        source = spark.readStream.schema(tables.EVENTS).parquet(f"{out}/events")
        stats = vwap.window_stats(vwap.window_sums(_trade_stream(spark, source), HOUR, vwap.LATENESS))
        rows = stats.select("update_time", "stock_code", "vwap", "total_volume", "message_count")
        start_table(rows, f"{out}/table", f"{out}/checkpoint", trigger=ONCE).awaitTermination()
    return spark.read.parquet(f"{out}/table")


def _report_sinks(out: str) -> tuple:
    return tuple(table_sink(f"{out}/{name}") for name in ("report", "anomalies", "messages"))


def q37_pending_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    """The archive lags: when a part of the feed is reported, the archive holds only the parts before. Anomalies
    wait and are completed in later batches, the last ones when the stream has ended."""
    out = run_folder(spark, "q37")
    events, dim = _events(spark, folder), store(_dim(spark, folder), "q37-dim")
    parts = ((None, "2024-01-10"), ("2024-01-10", "2024-01-20"), ("2024-01-20", None))
    archived = f"{out}/archive"
    write_archive(archive.archive_rows(tables.trade_records(events, "timestamp"), _arrival()).limit(0), archived)
    sinks = _report_sinks(out)
    settings = {"width": HOUR, "archive": lambda start, end: archived_trades(spark, archived, TRADE.tr_id, start, end)}
    for since, until in parts:
        part = events
        if since is not None:
            part = part.filter(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
        if until is not None:
            part = part.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
        part.write.mode("append").parquet(f"{out}/events")
        source = _trade_stream(spark, spark.readStream.schema(tables.EVENTS).parquet(f"{out}/events"))
        start_market_report(source, dim, f"{out}/checkpoint", *sinks, patience="60 days", trigger=ONCE, **settings).awaitTermination()
        write_archive(archive.archive_rows(tables.trade_records(part, "timestamp"), _arrival()), archived)
    finish_anomalies(spark, dim, f"{out}/checkpoint", *sinks[1:], **settings)
    return _flat_anomalies(spark.read.parquet(f"{out}/anomalies"))


def q38_breakdown_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The report per sector from the live feed: two aggregates in one query."""
    out = run_folder(spark, "q38")
    dim = joins.checked_broadcast(store(_dim(spark, folder), "q38"))
    rows = stream_breakdown(_trade_stream(spark, _event_stream(spark, folder)), dim, HOUR).drop("window")
    start_table(rows, f"{out}/table", f"{out}/checkpoint", ("report_date",), ONCE).awaitTermination()
    return spark.read.parquet(f"{out}/table").drop("report_date")


def q39_ordered_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Published records with a number per stock. The feed comes in three batches, each in disorder and each with
    the last third of the batch before delivered again."""
    out = run_folder(spark, "q39")
    events = _events(spark, folder)
    schema = tables.placed_frames(events).schema
    third = F.floor(3 * F.col("event_id") / (F.lit(1) + F.lit(events.agg(F.max("event_id")).first()[0])))
    for n in range(3):
        again = (third == n - 1) & (F.pmod(F.col("event_id"), F.lit(3)) == 0)
        # Events are dealt out, not the frames made of them: those are longer, and are made by all tasks then.
        batch = events.filter((third == n) | again).repartition(F.xxhash64("event_id"))
        tables.placed_frames(batch).write.mode("append").parquet(f"{out}/feed")
        source = spark.readStream.schema(schema).parquet(f"{out}/feed")
        rows = frames.publish_rows(source, keep=("partition", "offset", "record_no"))

        def sink(sent: DataFrame, batch_id: int) -> None:
            sent.write.mode("overwrite").parquet(f"{out}/published/batch={batch_id}")

        start_publishing(rows, f"{out}/checkpoint", sink, trigger=ONCE).awaitTermination()
    sent = spark.read.parquet(f"{out}/published")
    return sent.select("topic", "key", "partition", "offset", "record_no", "sequence", "value")


def q40_reconciled_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report of a stream that dropped late records, put right from the archive, window by window."""
    reported = store(q20_late_data(spark, folder), "q40")
    return reconcile.corrected(reported, tables.trade_records(_events(spark, folder)), HOUR)


def q41_late_windows(spark: SparkSession, folder: str) -> DataFrame:
    """In which windows the report and the archive differ, and how."""
    reported = store(q20_late_data(spark, folder), "q41")
    records = tables.trade_records(_events(spark, folder).filter("event_type <> 'view'"))
    return reconcile.differences(reported, records, HOUR).drop("window")


def q42_offset_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Offsets that are missing in an archive without error events and without a long run."""
    documents = archive.archive_rows(tables.dense_records(_events(spark, folder)))
    kept = documents.filter("not (metadata.offset between 100 and 180 and metadata.partition < 3)")
    starts = spark.range(8).select(
        F.lit(TRADE.tr_id).alias("topic"), F.col("id").cast("int").alias("partition"), F.lit(0).cast("long").alias("first_expected")
    )
    return offsets.missing_offsets(offsets.source_offsets(kept), starts)


def q43_archive_cutover(spark: SparkSession, folder: str) -> DataFrame:
    """Documents per topic, read while the archive is compacted: before, with days copied but not listed, with days
    listed, and when the stream has gone on and further days were compacted."""
    out = run_folder(spark, "q43")
    events, path, compacted = _events(spark, folder), f"{out}/archive", f"{out}/compacted"
    early = F.col("ts") < F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")

    def stream(part: DataFrame) -> None:
        part.write.mode("append").parquet(f"{out}/events")
        source = spark.readStream.schema(tables.EVENTS).parquet(f"{out}/events")
        start_archive(tables.topic_records(source), path, f"{out}/checkpoint", insert_time=_arrival(), trigger=ONCE).awaitTermination()

    def counted(phase: str) -> DataFrame:
        return store(archive.archive_counts(read_whole_archive(spark, path, compacted)).withColumn("phase", F.lit(phase)), "q43")

    stream(events.filter(early))
    found = [counted("before")]
    entries = store(copy_days(spark, path, compacted, F.lit("2024-01-15").cast("date")), "q43-days")
    found.append(counted("copied"))
    list_days(entries, compacted)
    found.append(counted("listed"))
    stream(events.filter(~early))
    compact_archive(spark, path, compacted, F.lit("2024-01-25").cast("date"))
    found.append(counted("later"))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows


def q44_schema_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Fields of raw messages that appear, vanish or change their type, by topic and day."""
    documents = archive.archive_rows(tables.changing_records(_events(spark, folder)), _arrival())
    fields = store(raw_schemas.day_fields(documents), "q44")
    return raw_schemas.field_changes(fields).withColumn("day", F.col("day").cast("string"))


def q45_replayed_letters(spark: SparkSession, folder: str) -> DataFrame:
    """Published with a layout that is too wide, then the dead letters replayed with the right one, twice."""
    # Events are dealt out, not the frames made of them: those are longer, and are made by all tasks then.
    placed = tables.placed_frames(_events(spark, folder).repartition(F.xxhash64("event_id")))
    feed = store(replay.with_frame_id(placed, ("partition", "offset")), "q45-feed", replay.COMPRESSION)
    wrong = (Layout(TRADE.tr_id, (*TRADE.fields, (TRADE.width + 25, "never_there", "strict"))), EXPECTED, ORDER_BOOK)
    done = store(replay.published(feed, wrong, 1), "q45-published", replay.COMPRESSION)
    dead = replay.letters(feed, wrong, 1)
    for version in (2, 3):
        dead = store(dead, "q45-letters", replay.COMPRESSION)
        fresh, dead = replay.replay(dead, done, (TRADE, EXPECTED, ORDER_BOOK), version)
        done = done.unionByName(fresh)  # what was published before is not written again
    return done.select("topic", "key", "value", "record_no", "layout_version")


def q46_sectors_by_time(spark: SparkSession, folder: str) -> DataFrame:
    """The report with the sectors of each window's own time, from three successive sector files."""
    path = f"{run_folder(spark, 'q46')}/sectors"
    entries = _entries(spark, folder)
    for day, without in (("2024-01-01", "none"), ("2024-01-10", "1-URGENT"), ("2024-01-20", "5-LOW")):
        kept = entries.withColumn("sectors", F.array_remove("sectors", without))
        write_sectors(kept, f"{path}/valid_from={day} 00%3A00%3A00")
    history = store(read_sector_history(spark, path, multiline=False), "q46")
    stats = market.market_stats(_records(spark, folder), HOUR)
    return vwap.report(sectors.enrich_windows(stats, history))


def _arrival() -> Column:
    """When a record reaches the archive: two seconds after it was sent."""
    return F.col("timestamp") + F.expr("interval 2 seconds")


def q14_archive_stream(spark: SparkSession, folder: str) -> DataFrame:
    out = run_folder(spark, "q14")
    sent = tables.topic_records(_event_stream(spark, folder))
    records = archive.kafka_millis(sent.withColumn("millis", F.unix_millis("timestamp")), "millis")
    start_archive(
        records, f"{out}/table", f"{out}/checkpoint", insert_time=_arrival(), trigger=ONCE
    ).awaitTermination()
    return read_archive(spark, f"{out}/table").select(
        "raw_data",
        "metadata.topic",
        "metadata.partition",
        "metadata.offset",
        "metadata.key",
        F.date_format("kafka_timestamp", MICROS).alias("kafka_timestamp"),
        F.date_format("insert_time", MICROS).alias("insert_time"),
        "insert_date",
        F.col("insert_day").cast("string").alias("insert_day"),
    )


def q32_sector_file(spark: SparkSession, folder: str) -> DataFrame:
    """The sector file, written and read back."""
    path = f"{run_folder(spark, 'q32')}/sectors"
    write_sectors(_entries(spark, folder), path)
    return read_sectors(spark, path, multiline=False)


def q33_frame_files(spark: SparkSession, folder: str) -> DataFrame:
    """Trade frames as lines of text, read as a stream and decoded."""
    out = run_folder(spark, "q33")
    tables.trade_frames(_events(spark, folder)).select(F.col("frame").alias("value")).write.text(f"{out}/frames")
    rows = frames.decode_trades(frame_files(spark, f"{out}/frames")).select(
        "stock_code", "stck_cntg_hour", F.col("stck_prpr").cast("double"), F.col("cntg_vol").cast("double"), F.col("acml_vol").cast("double")
    )
    start_table(rows, f"{out}/table", f"{out}/checkpoint", trigger=ONCE).awaitTermination()
    return spark.read.parquet(f"{out}/table")


def q34_stock_links(spark: SparkSession, folder: str) -> DataFrame:
    """Stock links in several spellings; links to anything else are left out."""
    pages = tables.linked_pages(_read(spark, folder, "pages"))
    links = sectors.sector_links(pages, sector=F.col("url"), page_order=F.col("page_id"), html=F.col("html"))
    return links.select("stock_code", "name", "sector", "page_order")


# --- archive and freshness ----------------------------------------------------------------------


def _archive_table(spark: SparkSession, folder: str, name: str) -> str:
    path = run_folder(spark, name)
    records = tables.topic_records(_events(spark, folder))
    write_archive(archive.archive_rows(records, _arrival()), path)
    return path


def _now() -> Column:
    return F.lit(NOW).cast("timestamp")


TOPICS = (TRADE.tr_id, EXPECTED.tr_id, ORDER_BOOK.tr_id, "H0STMKO0")


def q15_archive_counts(spark: SparkSession, folder: str) -> DataFrame:
    return archive.archive_counts(read_archive(spark, _archive_table(spark, folder, "q15")))


def q35_compacted_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Days before the last one, compacted; counted by topic and day."""
    path = _archive_table(spark, folder, "q35")
    target = f"{run_folder(spark, 'q35-compact')}/table"
    compact_days(read_archive(spark, path), target, F.lit("2024-01-31").cast("date"))
    documents = read_archive(spark, target)
    size = F.sum(F.length("raw_data")).alias("characters")
    return documents.groupBy("topic", F.col("insert_day").cast("string").alias("insert_day")).agg(F.count("*").alias("documents"), size)


def q16_latest_record(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_archive(spark, _archive_table(spark, folder, "q16"), TRADE.tr_id)
    return freshness.latest_record(documents, _now()).select(
        "topic", "metadata.partition", "metadata.offset", "metadata.key", "insert_date", "raw_data"
    )


def _checks(spark: SparkSession, folder: str, name: str) -> DataFrame:
    documents = read_archive(spark, _archive_table(spark, folder, name))
    return freshness.freshness(documents, TOPICS, _now())


def q17_freshness(spark: SparkSession, folder: str) -> DataFrame:
    return _checks(spark, folder, "q17").select(
        "topic", local_text(F.col("last_insert"), archive.ZONE).alias("last_insert"), "lag_seconds", "healthy"
    )


def q18_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return freshness.alerts(_checks(spark, folder, "q18"), "archive_freshness")


QUERIES: tuple[Query, ...] = (
    q01_parse_json,
    q02_decode_trades,
    q03_decode_expected,
    q04_decode_orderbook,
    q05_classify_frames,
    q06_dead_letters,
    q07_day_filter,
    q08_sector_explode,
    q09_sector_join,
    q10_vwap_batch,
    q11_vwap_stream,
    q12_anomalies,
    q13_anomaly_envelope,
    q14_archive_stream,
    q15_archive_counts,
    q16_latest_record,
    q17_freshness,
    q18_alerts,
    q19_sector_map,
    q20_late_data,
    q21_sector_breakdown,
    q22_publish_rows,
    q23_report_fanout,
    q24_orderbook_levels,
    q25_vwap_lineitem,
    q26_malformed_json,
    q27_vwap_trade_clock,
    q28_fanout_report,
    q29_fanout_messages,
    q30_lagging_archive,
    q31_batch_fanout,
    q32_sector_file,
    q33_frame_files,
    q34_stock_links,
    q35_compacted_archive,
    q36_today,
    q37_pending_anomalies,
    q38_breakdown_stream,
    q39_ordered_messages,
    q40_reconciled_report,
    q41_late_windows,
    q42_offset_gaps,
    q43_archive_cutover,
    q44_schema_changes,
    q45_replayed_letters,
    q46_sectors_by_time,
)


def entry(spark: SparkSession) -> DataFrame:
    """The VWAP report per stock and sector."""
    return q10_vwap_batch(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    own = {query.__name__: query for query in QUERIES}
    if llm_queries is None:
        return own
    return own | llm_queries.queries() | {"pipeline": corpus_pipeline.run}


# --- SQL ----------------------------------------------------------------------------------------

_TRADES = """trades AS (
  SELECT event_id, event_type, ts, user_id, CAST(user_id AS VARCHAR) AS stock_code,
         CAST(ROUND(value * 100) AS BIGINT) AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume
  FROM events)"""

_MESSAGES = f"""{_TRADES}, messages AS (
  SELECT * REPLACE (CASE WHEN user_id <> 1 THEN stock_code END AS stock_code), '{{"stck_prpr":"' || price || '","cntg_vol":"' || volume || '","acml_vol":"' || event_id
    || '","acml_tr_pbmn":"' || price * event_id
    || '","cttr":"100.00","total_askp_rsqn":"5000","total_bidp_rsqn":"5000"}}' AS message,
    CASE event_type WHEN 'view' THEN 'H0STANC0' WHEN 'click' THEN 'H0STASP0' ELSE 'H0STCNT0' END AS topic
  FROM trades)"""

_DIM = """dim AS (
  SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS stock_code, o_orderpriority AS sector, c_name AS name
  FROM customer JOIN orders ON c_custkey = o_custkey)"""


def _iso(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%dT%H:%M:%SZ')"


def _stats(width: str, source: str = "messages", where: str = "TRUE") -> str:
    return f"""stats AS (
  SELECT time_bucket(INTERVAL '{width}', ts) AS w, stock_code,
         CAST(SUM(price * volume) AS BIGINT) AS spv, CAST(SUM(volume) AS BIGINT) AS total_volume,
         MIN(price) AS min_price, MAX(price) AS max_price, CAST(TRUNC(AVG(price)) AS BIGINT) AS avg_price,
         COUNT(*) AS n
  FROM {source} WHERE {where} GROUP BY ALL)"""


_VWAP = "CAST(spv AS DOUBLE) / NULLIF(total_volume, 0)"
_CLOSED = "w + INTERVAL '{width}' <= (SELECT MAX(ts) FROM events) - INTERVAL '1 minute'"
_REPORT = f"""SELECT {_iso('w')} AS update_time, s.stock_code, sector, name, {_VWAP} AS vwap, total_volume
FROM stats s LEFT JOIN dim d ON s.stock_code = d.stock_code"""

_ODD = """min_price <> 0 AND avg_price <> 0 AND (max_price - min_price) / min_price >= 0.05
    AND (max_price - avg_price) / avg_price >= 0.03"""


def _anomalies(where: str = "TRUE") -> str:
    return f"""WITH {_MESSAGES}, {_DIM}, {_stats('1 hour')},
odd AS (SELECT * FROM stats WHERE {_ODD} AND {where}),
raw AS (
  SELECT o.w, o.stock_code, LIST(m.message ORDER BY m.message) AS list
  FROM messages m JOIN odd o ON m.stock_code IS NOT DISTINCT FROM o.stock_code AND time_bucket(INTERVAL '1 hour', m.ts) = o.w
  GROUP BY ALL),
rows AS (
  SELECT {_iso('o.w')} AS update_time, o.stock_code, sector, name, min_price, avg_price, max_price,
         total_volume, list
  FROM odd o JOIN raw r ON o.w = r.w AND o.stock_code IS NOT DISTINCT FROM r.stock_code
  LEFT JOIN dim d ON o.stock_code = d.stock_code)"""


_FLAT = """SELECT update_time, stock_code, sector, name, min_price, avg_price, max_price, total_volume,
  CAST(LEN(list) AS BIGINT) AS messages, array_to_string(list, chr(10)) AS raw_messages,
  0 AS part, 1 AS parts, TRUE AS messages_complete FROM rows"""

# Frames, written down independently of the Spark side: fixed positions, blank positions, cut.
_CLOCK = "strftime(ts, '%H%M%S')"
_FRAMES = {
    TRADE.tr_id: (
        {0: "stock_code", 1: _CLOCK, 2: "CAST(price AS VARCHAR)", 12: "CAST(volume AS VARCHAR)", 33: "strftime(ts, '%Y%m%d')"},
        "4",
        40,
    ),
    EXPECTED.tr_id: (
        {0: "stock_code", 1: _CLOCK, 6: "CASE event_type WHEN 'signup' THEN 'n/a' ELSE CAST(price + 6 AS VARCHAR) END"},
        "5",
        None,
    ),
    ORDER_BOOK.tr_id: ({0: "stock_code", 1: _CLOCK}, "3, 47, 48, 49, 50", 50),
}


_COUNT = "(1 + event_id % 3)"


def _parts(layout: Layout) -> str:
    """The values of record ``k`` of a frame."""
    fixed, blank, cut = _FRAMES[layout.tr_id]
    texts = ", ".join(str(i) for i, _, policy in layout.fields if policy == "text")
    cases = " ".join(f"WHEN i = {i}{' AND k = 0' if i == 2 else ''} THEN {value}" for i, value in fixed.items())
    parts = f"""list_transform(range({layout.width}), lambda i: CASE
      WHEN event_type = 'error' AND i IN ({blank}) THEN '' {cases}
      WHEN i IN ({texts}) THEN event_type || i
      WHEN i % 2 = 1 THEN (price + i + 1000 * k) || '.25' ELSE CAST(price + i + 1000 * k AS VARCHAR) END)"""
    parts = f"list_concat({parts}, CASE WHEN event_id % 7 = 0 AND event_type NOT IN ('signup', 'click') THEN ['added'] ELSE [] END)"
    if cut is None:
        return parts
    return f"CASE WHEN event_type = 'signup' AND k = {_COUNT} - 1 THEN ({parts})[1:{cut}] ELSE {parts} END"


def _frame(layout: Layout) -> str:
    records = f"list_transform(range({_COUNT}), lambda k: array_to_string({_parts(layout)}, '^'))"
    said = f"{_COUNT} + CASE WHEN event_type = 'click' AND event_id % 5 = 0 THEN 1 ELSE 0 END"
    return f"'0|{layout.tr_id}|' || lpad(CAST({said} AS VARCHAR), 3, '0') || '|' || array_to_string({records}, '^')"


def _split(frame: str) -> str:
    return f"string_split(string_split({frame}, '|')[4], '^')"


def _cut(rows: str, width: str) -> str:
    """Rows with ``frame``, one for each record: its number, its values and whether the count fits. Records
    are as long as the count says if they have added fields, else as wide as their kind."""
    said = "TRY_CAST(string_split(frame, '|')[3] AS INTEGER)"
    return f"""SELECT *, vals[record_no * step + 1 : record_no * step + w] AS p FROM (
    SELECT *, UNNEST(range(CAST(ceil(len(vals) / CAST(step AS DOUBLE)) AS BIGINT))) AS record_no,
      COALESCE(said = ceil(len(vals) / CAST(step AS DOUBLE)), FALSE) AS fits FROM (
      SELECT *, CASE WHEN said > 0 AND len(vals) % said = 0 AND len(vals) // said > w AND (len(vals) // said) % w <> 0
        THEN len(vals) // said ELSE w END AS step FROM (
        SELECT *, {_split("frame")} AS vals, {said} AS said, {width} AS w FROM {rows})))"""


def _number(i: int, policy: str) -> str:
    value = f"TRY_CAST(p[{i + 1}] AS DECIMAL(24, 4))"
    return f"CASE WHEN TRIM(p[{i + 1}]) = '' THEN 0 ELSE {value} END" if policy == "zero" else value


def _bad(layout: Layout) -> str:
    checks = []
    for i, _, policy in layout.fields:
        if policy != "text":
            check = f"TRY_CAST(p[{i + 1}] AS DECIMAL(24, 4)) IS NULL"
            checks.append(check if policy == "strict" else f"({check} AND TRIM(p[{i + 1}]) <> '')")
    return " OR ".join(checks)


def _decoded(layout: Layout, columns: str) -> str:
    return f"""WITH {_TRADES}, framed AS (SELECT event_id, {_frame(layout)} AS frame FROM trades),
split AS ({_cut("framed", str(layout.width))})
SELECT event_id, CAST(record_no AS INTEGER) AS record_no, {columns} FROM split
WHERE LEN(p) >= {layout.width} AND fits AND NOT ({_bad(layout)})"""


def _decode_sql(layout: Layout) -> str:
    columns = ["p[1] AS stock_code"]
    for i, name, policy in layout.fields:
        value = f"p[{i + 1}]" if policy == "text" else f"CAST({_number(i, policy)} AS DOUBLE)"
        columns.append(f"{value} AS {name}")
    return _decoded(layout, ", ".join(columns))


def _levels_sql() -> str:
    book = _decoded(ORDER_BOOK, "p")

    def pick(first: int) -> str:
        text = f"p[{first + 1} + level - 1]"
        return f"CAST(CASE WHEN TRIM({text}) = '' THEN 0 ELSE CAST({text} AS DECIMAL(24, 4)) END AS DOUBLE)"

    return f"""SELECT event_id, record_no, CAST(level AS INTEGER) AS level, {pick(3)} AS ask_price, {pick(23)} AS ask_qty,
  {pick(13)} AS bid_price, {pick(33)} AS bid_qty
FROM ({book}) book, range(1, 11) AS levels(level)"""


_MIXED = f"""mixed AS (
  SELECT event_id, event_type, frame_no, frames[frame_no + 1] AS frame FROM (
    SELECT event_id, event_type, UNNEST(range(6)) AS frame_no, [
      {_frame(TRADE)}, {_frame(EXPECTED)}, {_frame(ORDER_BOOK)},
      '0|H0STMKO0|001|' || stock_code || '^' || event_type,
      '{{"header":{{"tr_id":"PINGPONG","datetime":"' || strftime(ts, '%Y%m%d%H%M%S') || '"}}}}',
      '1|' || props] AS frames
    FROM trades JOIN (SELECT event_id, props FROM events) USING (event_id)))"""


def _reasons() -> str:
    return " ".join(
        f"""WHEN tr = '{layout.tr_id}' THEN
    CASE WHEN LEN(p) < {layout.width} THEN 'short_payload' WHEN NOT fits THEN 'bad_count' WHEN {_bad(layout)} THEN 'bad_number' END"""
        for layout in (TRADE, EXPECTED, ORDER_BOOK)
    )


_WIDTH = "CASE tr " + " ".join(f"WHEN '{x.tr_id}' THEN {x.width}" for x in (TRADE, EXPECTED, ORDER_BOOK)) + " END"
_KNOWN = ", ".join(f"'{x.tr_id}'" for x in (TRADE, EXPECTED, ORDER_BOOK))
_JUDGED = f"""judged AS (
  SELECT *, CASE WHEN frame[1] = '{{' THEN NULL WHEN frame[1] <> '0' THEN 'unknown_frame'
    {_reasons()} ELSE 'unknown_tr' END AS reason
  FROM ({_cut("(SELECT *, string_split(frame, '|')[2] AS tr FROM mixed)", _WIDTH)}
    UNION ALL BY NAME SELECT *, string_split(frame, '|')[2] AS tr, 0 AS record_no FROM mixed
    WHERE NOT (frame[1] = '0' AND string_split(frame, '|')[2] IN ({_KNOWN}))))"""


def _message_json(layout: Layout) -> str:
    fields = []
    for i, name, policy in layout.fields:
        text = f"p[{i + 1}]"
        if policy == "zero":
            text = f"CASE WHEN TRIM({text}) = '' THEN '0' ELSE TRIM({text}) END"
        elif policy == "null":
            text = f"NULLIF(TRIM({text}), '')"
        fields.append(f"{name} := {text}")
    return f"to_json(struct_pack({', '.join(fields)}))"


def _publish_sql() -> str:
    kinds = " ".join(
        f"WHEN '{layout.tr_id}' THEN {_message_json(layout)}" for layout in (TRADE, EXPECTED, ORDER_BOOK)
    )
    return f"""WITH {_TRADES}, {_MIXED}, {_JUDGED}
SELECT tr AS topic, p[1] AS key, CAST(CASE tr {kinds} END AS VARCHAR) AS value
FROM judged WHERE reason IS NULL AND frame[1] = '0'"""


_ARRIVED = "ts + INTERVAL '2 seconds'"
_SEOUL = "strftime({} + INTERVAL '9 hours', '%Y-%m-%d %H:%M:%S')"
_TODAY = f"{_ARRIVED} >= TIMESTAMP '2024-01-30 15:00:00'"  # midnight of 2024-01-31 in Seoul
_TOPIC_ROWS = ", ".join(f"('{topic}')" for topic in TOPICS)
_CHECKS = f"""checks AS (
  SELECT t.topic, last, (epoch_us(TIMESTAMP '{NOW}') - epoch_us(last)) / 1000000.0::DOUBLE AS lag_seconds
  FROM (VALUES {_TOPIC_ROWS}) t(topic)
  LEFT JOIN (SELECT topic, MAX({_ARRIVED}) AS last FROM messages WHERE {_TODAY} GROUP BY topic) m
  ON t.topic = m.topic)"""


_PLACED = f"""placed AS (
  SELECT j.*, CAST(user_id % 8 AS INTEGER) AS partition, 2 * event_id + frame_no AS "offset"
  FROM judged j JOIN (SELECT event_id, user_id FROM events) USING (event_id)
  WHERE frame_no < 2 AND reason IS NULL AND frame[1] = '0')"""


def _placed_sql(columns: str) -> str:
    kinds = " ".join(f"WHEN '{layout.tr_id}' THEN {_message_json(layout)}" for layout in (TRADE, EXPECTED))
    return f"""WITH {_TRADES}, {_MIXED}, {_JUDGED}, {_PLACED}
SELECT tr AS topic, p[1] AS key, CAST(CASE tr {kinds} END AS VARCHAR) AS value, CAST(record_no AS INTEGER) AS record_no, {columns} FROM placed"""


def _reported(late: str, closed: str) -> str:
    """What the report of q20 holds, and what an archive without ``view`` events holds."""
    return f"""WITH {_MESSAGES}, {_stats('1 hour', where=late)},
reported AS (SELECT w, stock_code, n AS message_count FROM stats WHERE {closed}),
archived AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS w, stock_code, COUNT(*) AS archived FROM messages
  WHERE event_type <> 'view' GROUP BY ALL)
SELECT {_iso('COALESCE(r.w, a.w)')} AS update_time, CASE WHEN r.w IS NULL THEN a.stock_code ELSE r.stock_code END AS stock_code,
  COALESCE(message_count, 0) AS message_count, COALESCE(archived, 0) AS archived,
  CASE WHEN r.w IS NULL THEN 'not reported' WHEN COALESCE(archived, 0) > message_count THEN 'late records dropped' ELSE 'archive behind' END AS reason
FROM reported r FULL JOIN archived a ON r.w = a.w AND r.stock_code IS NOT DISTINCT FROM a.stock_code
WHERE COALESCE(message_count, 0) <> COALESCE(archived, 0)"""


_GAPS = f"""WITH kept AS (
  SELECT DISTINCT event_id % 8 AS p, event_id // 8 AS o FROM events
  WHERE event_type <> 'error' AND NOT (event_id // 8 BETWEEN 100 AND 180 AND event_id % 8 < 3)),
gaps AS (
  SELECT p, LAG(o) OVER (PARTITION BY p ORDER BY o) + 1 AS f, o - 1 AS l FROM kept
  UNION ALL SELECT s.p, 0, MIN(o) - 1 FROM range(8) s(p) LEFT JOIN kept k ON k.p = s.p GROUP BY s.p)
SELECT '{TRADE.tr_id}' AS topic, CAST(p AS INTEGER) AS partition, CAST(f AS BIGINT) AS first_missing, CAST(l AS BIGINT) AS last_missing,
  CAST(l - f + 1 AS BIGINT) AS missing FROM gaps WHERE f IS NOT NULL AND (l IS NULL OR l >= f)"""

_CUTOVER = """
SELECT topic, COUNT(*) AS documents, phase FROM messages, (VALUES ('before'), ('copied'), ('listed'), ('later')) phases(phase)
WHERE phase = 'later' OR ts < TIMESTAMP '2024-01-20 12:00:00' GROUP BY topic, phase"""

_CHANGES = f"""WITH {_MESSAGES}, sent AS (
  SELECT topic, CAST(ts + INTERVAL '2 seconds' + INTERVAL '9 hours' AS DATE) AS day, ts FROM messages),
members AS (
  SELECT topic, day, UNNEST(list_filter([
      {{'field': 'stck_prpr', 'type': 'STRING'}}, {{'field': 'cntg_vol', 'type': 'BIGINT'}},
      {{'field': 'cttr', 'type': CASE WHEN ts >= TIMESTAMP '{tables.NEW_TYPE}' THEN 'BIGINT' ELSE 'STRING' END}},
      CASE WHEN ts < TIMESTAMP '{tables.NO_FIELD}' THEN {{'field': 'total_bidp_rsqn', 'type': 'STRING'}} END,
      CASE WHEN ts >= TIMESTAMP '{tables.NEW_FIELD}' THEN {{'field': 'venue', 'type': 'STRING'}} END], lambda m: m IS NOT NULL), recursive := true)
  FROM sent),
days AS (SELECT topic, day, row_number() OVER (PARTITION BY topic ORDER BY day) AS no, LEAD(day) OVER (PARTITION BY topic ORDER BY day) AS next
  FROM (SELECT DISTINCT topic, day FROM sent)),
seen AS (
  SELECT *, LAG(no) OVER f AS no_before, LAG(type) OVER f AS type_before, LEAD(no) OVER f AS no_after
  FROM (SELECT DISTINCT topic, day, field, type FROM members) JOIN days USING (topic, day) WINDOW f AS (PARTITION BY topic, field ORDER BY no))
SELECT topic, CAST(day AS VARCHAR) AS day, field, CASE WHEN no = 1 THEN 'first day' WHEN no_before IS NULL OR no_before < no - 1 THEN 'appears' ELSE 'changes type' END AS change,
  type, type_before FROM seen WHERE no = 1 OR no_before IS NULL OR no_before < no - 1 OR type <> type_before
UNION ALL SELECT topic, CAST(next AS VARCHAR), field, 'vanishes', NULL, type FROM seen WHERE next IS NOT NULL AND (no_after IS NULL OR no_after > no + 1)"""


def oracle_sql() -> dict[str, str]:
    return _own_sql() | (llm_queries.oracle_sql() if llm_queries is not None else {})


def _own_sql() -> dict[str, str]:
    closed_30s, closed_hour = (_CLOSED.format(width=w) for w in ("30 seconds", "1 hour"))
    late = """(event_type <> 'error' OR time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour'
      > (SELECT MAX(ts) FROM events WHERE event_type <> 'error') - INTERVAL '1 minute')"""
    millis = "date_trunc('milliseconds', ts)"
    return {
        "q01_parse_json": f"""WITH {_MESSAGES}
SELECT event_id, stock_code, CAST(strlen(message) AS INTEGER) AS message_size_bytes,
  message AS original_message, CAST(json_extract_string(message, '$.stck_prpr') AS BIGINT) AS whole_price,
  CAST(json_extract_string(message, '$.cntg_vol') AS BIGINT) AS volume,
  json_extract_string(message, '$.acml_vol') AS acml_vol, json_extract_string(message, '$.cttr') AS cttr
FROM messages""",
        "q02_decode_trades": _decode_sql(TRADE),
        "q03_decode_expected": _decode_sql(EXPECTED),
        "q04_decode_orderbook": _decode_sql(ORDER_BOOK),
        "q05_classify_frames": f"""WITH {_TRADES}, {_MIXED}
SELECT event_type, CASE frame[1] WHEN '0' THEN 'data' WHEN '{{' THEN 'control' ELSE 'unknown' END AS frame_class,
  COUNT(*) AS frames FROM mixed GROUP BY ALL""",
        "q06_dead_letters": f"""WITH {_TRADES}, {_MIXED}, {_JUDGED}
SELECT event_id, CAST(frame_no AS INTEGER) AS frame_no, CAST(record_no AS INTEGER) AS record_no, reason, frame FROM judged WHERE reason IS NOT NULL""",
        "q07_day_filter": f"""WITH {_MESSAGES}
SELECT event_id, stock_code, message AS original_message FROM messages WHERE CAST(ts AS DATE) = DATE '{DAY}'""",
        "q08_sector_explode": f"WITH {_DIM} SELECT stock_code, sector, name FROM dim",
        "q09_sector_join": f"""WITH {_MESSAGES}, {_DIM}
SELECT event_id, m.stock_code, sector, name, CAST(strlen(message) AS INTEGER) AS message_size_bytes
FROM messages m LEFT JOIN dim d ON m.stock_code = d.stock_code""",
        "q10_vwap_batch": f"WITH {_MESSAGES}, {_DIM}, {_stats('30 seconds')} {_REPORT}",
        "q11_vwap_stream": f"WITH {_MESSAGES}, {_DIM}, {_stats('30 seconds')} {_REPORT} WHERE {closed_30s}",
        "q12_anomalies": f"{_anomalies()} {_FLAT}",
        "q13_anomaly_envelope": f"""{_anomalies()}
SELECT stock_code AS key, CAST(json_merge_patch('{{}}', to_json(struct_pack(update_time := update_time, stock_code := stock_code,
  sector := sector, name := name, min_price := min_price, avg_price := avg_price, max_price := max_price,
  total_volume := total_volume, raw_messages := list, part := 0, parts := 1, messages_complete := TRUE))) AS VARCHAR) AS value
FROM rows""",
        "q14_archive_stream": f"""WITH {_MESSAGES}, sent AS (SELECT *, {millis} AS t FROM messages)
SELECT message AS raw_data, topic, CAST(user_id % 8 AS INTEGER) AS partition, event_id AS "offset",
  stock_code AS key, strftime(t, '%Y-%m-%d %H:%M:%S.%f') AS kafka_timestamp,
  strftime(t + INTERVAL '2 seconds', '%Y-%m-%d %H:%M:%S.%f') AS insert_time,
  {_SEOUL.format("t + INTERVAL '2 seconds'")} AS insert_date,
  strftime(t + INTERVAL '2 seconds' + INTERVAL '9 hours', '%Y-%m-%d') AS insert_day FROM sent""",
        "q15_archive_counts": f"WITH {_MESSAGES} SELECT topic, COUNT(*) AS documents FROM messages GROUP BY topic",
        "q16_latest_record": f"""WITH {_MESSAGES}
SELECT topic, CAST(user_id % 8 AS INTEGER) AS partition, event_id AS "offset", stock_code AS key,
  {_SEOUL.format(_ARRIVED)} AS insert_date, message AS raw_data
FROM messages WHERE topic = 'H0STCNT0' AND {_TODAY} ORDER BY ts DESC, user_id % 8 DESC, event_id DESC LIMIT 1""",
        "q17_freshness": f"""WITH {_MESSAGES}, {_CHECKS}
SELECT topic, {_SEOUL.format('last')} AS last_insert, lag_seconds, COALESCE(lag_seconds < 300, FALSE) AS healthy
FROM checks""",
        "q18_alerts": f"""WITH {_MESSAGES}, {_CHECKS}
SELECT 'archive_freshness' AS job, topic, '2024-01-31 08:59:00' AS run_time, lag_seconds
FROM checks WHERE NOT COALESCE(lag_seconds < 300, FALSE)""",
        "q19_sector_map": r"""WITH anchors AS (
  SELECT page_id, url, UNNEST(regexp_extract_all(html, '<a [^>]*href="([^"]+)"[^>]*>([^<]*)</a>', 1)) AS code,
    UNNEST(regexp_extract_all(html, '<a [^>]*href="([^"]+)"[^>]*>([^<]*)</a>', 2)) AS name,
    UNNEST(range(len(regexp_extract_all(html, '<a [^>]*href="([^"]+)"[^>]*>([^<]*)</a>')))) AS pos
  FROM pages),
links AS (SELECT * FROM anchors WHERE code <> ''),
names AS (SELECT code, arg_min(name, (page_id, pos)) AS name FROM links GROUP BY code)
SELECT code AS stock_code, ANY_VALUE(n.name) AS name, string_agg(url, ' ' ORDER BY page_id, pos) AS sectors, part
FROM (SELECT *, (row_number() OVER (PARTITION BY code ORDER BY page_id, pos) - 1) // 10000 AS part FROM links) l
JOIN names n USING (code) GROUP BY code, part""",
        "q20_late_data": f"""WITH {_MESSAGES}, {_stats('1 hour', where=late)}
SELECT {_iso('w')} AS update_time, stock_code, {_VWAP} AS vwap, total_volume, n AS message_count
FROM stats WHERE {closed_hour}""",
        "q21_sector_breakdown": f"""WITH {_MESSAGES}, {_DIM}, {_stats('1 hour')}
SELECT {_iso('w')} AS update_time, sector, COUNT(*) AS stocks, CAST(SUM(total_volume) AS BIGINT) AS sector_volume,
  CAST(SUM(spv) AS DOUBLE) / NULLIF(SUM(total_volume), 0) AS sector_vwap
FROM stats s LEFT JOIN dim d ON s.stock_code = d.stock_code GROUP BY ALL""",
        "q22_publish_rows": _publish_sql(),
        "q23_report_fanout": f"{_anomalies(closed_hour)} {_FLAT}",
        "q24_orderbook_levels": _levels_sql(),
        "q25_vwap_lineitem": f"""WITH items AS (
  SELECT l_shipdate AS ts, CAST(l_partkey AS VARCHAR) AS stock_code,
    CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS price, CAST(l_quantity AS BIGINT) AS volume FROM lineitem),
{_stats('1 day', 'items')}
SELECT {_iso('w')} AS update_time, stock_code, {_VWAP} AS vwap, total_volume, min_price, avg_price, max_price
FROM stats""",
        "q26_malformed_json": f"""WITH {_MESSAGES}
SELECT event_id, CASE event_type WHEN 'error' THEN message[1:-2] ELSE '"no trade"' END AS value,
  'bad_json' AS reason FROM messages WHERE event_type IN ('error', 'signup')""",
        "q28_fanout_report": f"WITH {_MESSAGES}, {_DIM}, {_stats('1 hour')} {_REPORT} WHERE {closed_hour}",
        "q29_fanout_messages": f"""{_anomalies(closed_hour)}
SELECT stock_code AS key, update_time, sector, array_to_string(list, chr(10)) AS raw_messages, 0 AS part, 1 AS parts FROM rows""",
        "q30_lagging_archive": f"""WITH {_MESSAGES}, {_stats('1 hour')}, odd AS (SELECT * FROM stats WHERE {_ODD})
SELECT {_iso('o.w')} AS update_time, o.stock_code,
  COALESCE(string_agg(m.message, chr(10) ORDER BY m.message), '') AS raw_messages, COUNT(m.message) = ANY_VALUE(n) AS messages_complete
FROM odd o LEFT JOIN messages m ON m.stock_code IS NOT DISTINCT FROM o.stock_code
  AND time_bucket(INTERVAL '1 hour', m.ts) = o.w AND m.event_type NOT IN ('view', 'click')
GROUP BY o.w, o.stock_code""",
        "q31_batch_fanout": f"""WITH {_MESSAGES}, {_DIM}, {_stats('1 hour')}
SELECT {_iso('w')} AS update_time, s.stock_code, sector, name, {_VWAP} AS vwap, total_volume, COALESCE({_ODD}, FALSE) AS odd
FROM stats s LEFT JOIN dim d ON s.stock_code = d.stock_code""",
        "q32_sector_file": f"WITH {_DIM} SELECT stock_code, sector, name FROM dim",
        "q33_frame_files": f"""SELECT stock_code, stck_cntg_hour, stck_prpr, cntg_vol, acml_vol FROM ({_decode_sql(TRADE)}) decoded""",
        "q34_stock_links": """SELECT lpad(CAST(page_id % 40 AS VARCHAR), 6, '0') AS stock_code,
  'stock ' || lpad(CAST(page_id % 40 AS VARCHAR), 6, '0') AS name, url AS sector, page_id AS page_order FROM pages
UNION ALL SELECT lpad(CAST(page_id % 7 AS VARCHAR), 6, '9'), 'nine', url, page_id FROM pages""",
        "q35_compacted_archive": f"""WITH {_MESSAGES}, placed AS (
  SELECT topic, message, strftime({_ARRIVED} + INTERVAL '9 hours', '%Y-%m-%d') AS insert_day FROM messages)
SELECT topic, insert_day, COUNT(*) AS documents, CAST(SUM(len(message)) AS BIGINT) AS characters
FROM placed WHERE insert_day < '2024-01-31' GROUP BY topic, insert_day""",
        "q36_today": f"""WITH {_MESSAGES}
SELECT event_id, stock_code, message AS original_message FROM messages WHERE CAST(ts AS DATE) = DATE '{DAY}'""",
        "q37_pending_anomalies": f"{_anomalies(closed_hour)} {_FLAT}",
        "q38_breakdown_stream": f"""WITH {_MESSAGES}, {_DIM}, {_stats('1 hour')}
SELECT {_iso('w')} AS update_time, sector, COUNT(*) AS stocks, CAST(SUM(total_volume) AS BIGINT) AS sector_volume,
  CAST(SUM(spv) AS DOUBLE) / NULLIF(SUM(total_volume), 0) AS sector_vwap
FROM stats s LEFT JOIN dim d ON s.stock_code = d.stock_code WHERE {closed_hour} GROUP BY ALL""",
        "q39_ordered_messages": _placed_sql(
            'partition, "offset", row_number() OVER (PARTITION BY tr, p[1] ORDER BY partition, "offset", record_no) AS sequence'
        ),
        "q40_reconciled_report": f"""WITH {_MESSAGES}, {_stats('1 hour')}
SELECT {_iso('w')} AS update_time, stock_code, {_VWAP} AS vwap, total_volume, n AS message_count FROM stats""",
        "q41_late_windows": _reported(late, closed_hour),
        "q42_offset_gaps": _GAPS,
        "q43_archive_cutover": f"WITH {_MESSAGES} {_CUTOVER}",
        "q44_schema_changes": _CHANGES,
        "q45_replayed_letters": _placed_sql(f"CASE tr WHEN '{TRADE.tr_id}' THEN 2 ELSE 1 END AS layout_version"),
        "q46_sectors_by_time": f"""WITH {_MESSAGES}, {_DIM}, {_stats('1 hour')}
SELECT {_iso('w')} AS update_time, s.stock_code, sector, name, {_VWAP} AS vwap, total_volume
FROM stats s LEFT JOIN dim d ON s.stock_code = d.stock_code AND CASE WHEN w < TIMESTAMP '2024-01-10' THEN TRUE
  WHEN w < TIMESTAMP '2024-01-20' THEN sector <> '1-URGENT' ELSE sector <> '5-LOW' END""",
        "q27_vwap_trade_clock": f"""WITH {_TRADES}, {_DIM},
clocked AS (SELECT * REPLACE (date_trunc('second', ts) AS ts, price + CASE k WHEN 0 THEN 0 ELSE 2 + 1000 * k END AS price)
  FROM (SELECT *, UNNEST(range({_COUNT})) AS k FROM trades)
  WHERE event_type <> 'error' AND NOT (event_type = 'signup' AND k = {_COUNT} - 1)
    AND NOT (event_type = 'click' AND event_id % 5 = 0)),
{_stats('30 seconds', 'clocked')} {_REPORT}""",
    }
