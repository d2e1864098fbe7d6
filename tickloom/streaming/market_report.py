"""The market report as a stream."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.clock import iso_text
from tickloom.operators import raw_messages as raw
from tickloom.operators import vwap
from tickloom.operators.sectors import enrich, enrich_windows
from tickloom.session import store
from tickloom.sources.sinks import Sink
from tickloom.streaming.books import Ledger, Versions

ArchivedTrades = Callable[[datetime, datetime], DataFrame]
#: The sector dimension, or a function that reads it anew for each batch with closed windows.
Dimension = DataFrame | Callable[[], DataFrame]

# How long, in event time, an anomaly waits for messages that the archive does not have yet.
PATIENCE = "10 minutes"
# What is kept of an anomaly that waits. Its messages are in the archive or will be.
WAITING = (
    "window struct<start:timestamp,end:timestamp>, stock_code string, update_time string, min_price bigint, avg_price bigint, "
    "max_price bigint, total_volume bigint, message_count bigint, message_bytes bigint, report_date date"
)
WAITING_COLUMNS = [field.split()[0] for field in WAITING.split(", ")]
LISTED = f"{WAITING}, raw_messages array<string>, part int, parts int, messages_complete boolean, ready boolean"


def with_report_date(rows: DataFrame) -> DataFrame:
    """Day of the window in the session zone; the tables roll over by themselves."""
    return rows.withColumn("report_date", F.to_date(F.col("window.start")))


def stream_stats(
    trades: DataFrame, dim: DataFrame, width: str = vwap.WINDOW, lateness: str = vwap.LATENESS
) -> DataFrame:
    """Enriched statistics of closed windows as a stream, for one query per sink."""
    sums = vwap.window_sums(trades, width, lateness)
    return with_report_date(enrich(vwap.window_stats(sums), dim))


def stream_breakdown(
    trades: DataFrame,
    dim: DataFrame,
    width: str = vwap.WINDOW,
    lateness: str = vwap.LATENESS,
    over: str | None = None,
) -> DataFrame:
    """The report per sector as a stream: sums per (window, stock) feed sums per (window, sector) in one query.

    The second aggregate takes the event time of the first one's windows, so a sector's row comes out with
    append output when all of its stocks' windows are closed. ``over`` gives wider windows for it, a whole
    multiple of ``width``; ``stocks`` then counts a stock in each window that it was traded in. Its state
    holds one row per open window and sector.
    """
    sums = vwap.window_sums(trades, width, lateness).select(
        F.window_time("window").alias("at"), "stock_code", "sum_price_volume", "sum_volume"
    )
    grouped = (
        enrich(sums, dim)
        .groupBy(F.window("at", over or width), "sector")
        .agg(*vwap.sector_sums())
    )
    return with_report_date(vwap.sector_figures(grouped.withColumn("update_time", iso_text(F.col("window.start"))), "window"))


class _Books:
    """What the report remembers: anomalies that wait, those of the batch at work without and with messages, finished steps."""

    def __init__(self, spark: SparkSession, path: str):
        self.waiting = Versions(spark, f"{path}/waiting", WAITING)
        self.found = Versions(spark, f"{path}/found", WAITING)
        self.listed = Versions(spark, f"{path}/listed", LISTED)
        self.ledger = Ledger(spark, f"{path}/ledger")


def _books_path(checkpoint: str, books: str | None) -> str:
    return books or f"{checkpoint.rstrip('/')}-books"


def _reader(dim: Dimension) -> Callable[[], DataFrame]:
    if callable(dim):
        return dim
    stored = store(dim, "report-dim")
    return lambda: stored


def _listed(found: DataFrame, archive: ArchivedTrades, width: str, list_bytes: int) -> DataFrame:
    """Anomalous windows with the messages that the archive has by now."""
    start, end = found.agg(F.min("window.start"), F.max("window.end")).first()
    if start is None:  # no anomalies: an empty range
        start = end = datetime(1970, 1, 2)
    return raw.with_messages(found, archive(start, end), width, list_bytes=list_bytes)


def _write_anomalies(
    odd: DataFrame, batch_id: int, ledger: Ledger, anomaly_sink: Sink, message_sink: Sink
) -> None:
    rows = odd.select(*vwap.MESSAGE_FIELDS, "report_date")
    ledger.once(batch_id, "anomalies", lambda: anomaly_sink(rows, batch_id))
    messages = vwap.anomaly_messages(odd, keep=["report_date"])
    ledger.once(batch_id, "messages", lambda: message_sink(messages, batch_id))


def start_market_report(
    trades: DataFrame,
    dim: Dimension,
    checkpoint: str,
    report_sink: Sink,
    anomaly_sink: Sink,
    message_sink: Sink,
    archive: ArchivedTrades,
    width: str = vwap.WINDOW,
    lateness: str = vwap.LATENESS,
    spread: float = vwap.SPREAD,
    above_mean: float = vwap.ABOVE_MEAN,
    patience: str = PATIENCE,
    list_bytes: int = raw.LIST_BYTES,
    books: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """One query, three outputs: the source is read once and the state, sums only, is kept once.

    ``archive`` is a function that gives the parsed trades of a time range; the messages of anomalous windows
    alone are looked up there. An anomaly whose messages are not all archived yet waits: it is looked up
    again in later batches and written once, when it is complete or when windows that end ``patience``
    later are closed (then with ``messages_complete`` false). :func:`finish_anomalies` writes those that
    wait when a stream is ended for good.

    A ledger in the folder ``books`` (beside the checkpoint unless given) keeps which sink has finished which
    batch, and the anomalies of a batch are stored before the first sink gets them: a batch that is repeated
    after a failure goes on with the sinks that are missing, with the same rows.

    A dimension that is given as a table is stored when the stream starts. A function is called in each batch
    with closed windows, so that new sector files take effect; with the columns ``valid_from, valid_until``
    (:func:`tickloom.operators.sectors.validity`) each window gets the sectors of its own time.
    """
    spark = trades.sparkSession
    read_dim = _reader(dim)
    sums = vwap.window_sums(trades, width, lateness)
    book = _Books(spark, _books_path(checkpoint, books))

    def find_anomalies(stats: DataFrame, batch_id: int) -> None:
        waiting = book.waiting.before(batch_id)
        fresh = vwap.anomalies(stats, spread, above_mean).select(*[F.col(name) for name in WAITING_COLUMNS])
        # Written, not persisted: a plan that uses them more than once does not find what is persisted of a stream's
        # batch, and computes the state again instead.
        book.found.write(batch_id, fresh.unionByName(waiting))
        found = book.found.at(batch_id)
        newest = stats.agg(F.max("window.end")).first()[0]
        over = F.lit(False)
        if newest is not None:
            over = F.col("window.end") + F.expr(f"interval {patience}") <= F.lit(newest)
        listed = _listed(found, archive, width, list_bytes).withColumn("ready", F.col("messages_complete") | over)
        book.listed.write(batch_id, listed)
        book.waiting.write(batch_id, book.listed.at(batch_id).filter("not ready and part = 0"))

    def write(closed: DataFrame, batch_id: int) -> None:
        closed.persist()
        try:
            # One job computes all closed windows and commits their state; most batches have none.
            nothing = closed.count() == 0
            if nothing and not book.waiting.before(batch_id).head(1):
                return
            stats = with_report_date(vwap.window_stats(closed))
            dim = read_dim()
            report = enrich_windows(stats, dim).select(*vwap.REPORT_COLUMNS, "report_date")
            book.ledger.once(batch_id, "report", lambda: report_sink(report, batch_id))
            book.ledger.once(batch_id, "listed", lambda: find_anomalies(stats, batch_id))
            odd = enrich_windows(book.listed.at(batch_id).filter("ready"), dim)
            _write_anomalies(odd, batch_id, book.ledger, anomaly_sink, message_sink)
        finally:
            closed.unpersist()

    return _started(sums, write, checkpoint, trigger)


def finish_anomalies(
    spark: SparkSession,
    dim: Dimension,
    checkpoint: str,
    anomaly_sink: Sink,
    message_sink: Sink,
    archive: ArchivedTrades,
    width: str = vwap.WINDOW,
    list_bytes: int = raw.LIST_BYTES,
    books: str | None = None,
) -> None:
    """Write the anomalies that still wait, with what the archive holds now. For a stream that has ended.

    Sinks get a batch number below zero, one for each batch the stream may have ended with, so that a repeated
    call writes the same and a second one nothing."""
    book = _Books(spark, _books_path(checkpoint, books))
    last = book.waiting.last()
    waiting = book.waiting.at(last)
    if not waiting.head(1):
        return
    batch_id = -2 - last
    listed = store(_listed(waiting, archive, width, list_bytes), "finished")
    odd = enrich_windows(listed, _reader(dim)())
    anomaly_sink(odd.select(*vwap.MESSAGE_FIELDS, "report_date"), batch_id)
    message_sink(vwap.anomaly_messages(odd, keep=["report_date"]), batch_id)
    book.waiting.write(last)


def start_market_report_keeping_messages(
    trades: DataFrame,
    dim: DataFrame,
    checkpoint: str,
    report_sink: Sink,
    anomaly_sink: Sink,
    message_sink: Sink,
    width: str = vwap.WINDOW,
    lateness: str = vwap.LATENESS,
    spread: float = vwap.SPREAD,
    above_mean: float = vwap.ABOVE_MEAN,
    slices: int = 16,
    list_bytes: int = raw.LIST_BYTES,
    trigger: dict | None = None,
) -> StreamingQuery:
    """:func:`start_market_report` without an archive: the messages of all open windows are kept in the state, cut
    into ``slices`` per window and stock, and are exactly those that were counted. Only for feeds whose
    open windows fit the state."""
    dim = store(dim, "report-dim")
    sums = vwap.window_sums(trades, width, lateness, slices)

    def write(closed: DataFrame, batch_id: int) -> None:
        closed.persist()
        odd = None
        try:
            if closed.count() == 0:
                return
            stats = with_report_date(vwap.window_stats(vwap.merge_slices(closed)))
            found = vwap.anomalies(stats, spread, above_mean)
            # Two sinks take the anomalies; their messages are gathered once.
            odd = enrich(raw.with_sliced_messages(found, closed, list_bytes), dim).persist()
            report_sink(enrich(stats, dim).select(*vwap.REPORT_COLUMNS, "report_date"), batch_id)
            anomaly_sink(odd.select(*vwap.MESSAGE_FIELDS, "report_date"), batch_id)
            message_sink(vwap.anomaly_messages(odd, keep=["report_date"]), batch_id)
        finally:
            if odd is not None:
                odd.unpersist()
            closed.unpersist()

    return _started(sums, write, checkpoint, trigger)


def _started(sums: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        sums.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )
