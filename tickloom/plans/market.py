"""Batch form of the market report over a table of Kafka-shaped records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import raw_messages as raw
from tickloom.operators import vwap
from tickloom.operators.sectors import enrich
from tickloom.operators.trades import parse_trades
from tickloom.session import store

IDS = ("partition", "offset")


def market_stats(records: DataFrame, width: str = vwap.WINDOW) -> DataFrame:
    """Window statistics per stock, without sectors."""
    return vwap.window_stats(vwap.window_sums(parse_trades(records), width))


def vwap_report(records: DataFrame, dim: DataFrame, width: str = vwap.WINDOW) -> DataFrame:
    return vwap.report(enrich(market_stats(records, width), dim))


def report_and_anomalies(
    records: DataFrame, dim: DataFrame, width: str = vwap.WINDOW, **thresholds: float
) -> tuple[DataFrame, DataFrame]:
    """The report and the anomalies with their messages, from one aggregate of the records.

    The window statistics are stored in the shared folder when this function is called; both results
    read them. A second pass gathers the messages of anomalous windows alone, from the time range of
    these windows, a filter that reaches the scan.
    """
    stats = store(market_stats(records, width), "stats")
    return vwap.report(enrich(stats, dim)), _anomalies(records, stats, dim, width, **thresholds)


def _anomalies(records: DataFrame, stats: DataFrame, dim: DataFrame, width: str, **thresholds: float) -> DataFrame:
    found = store(vwap.anomalies(stats, **thresholds), "anomalies")
    start, end = found.agg(F.min("window.start"), F.max("window.end")).first()
    time = records.schema["timestamp"].dataType
    between = F.lit(False)
    if start is not None:
        between = (F.col("timestamp") >= F.lit(start).cast(time)) & (F.col("timestamp") < F.lit(end).cast(time))
    parsed = parse_trades(records.filter(between), keep=IDS)
    return vwap.anomaly_rows(enrich(raw.with_messages(found, parsed, width, IDS), dim))


def price_anomalies(
    records: DataFrame, dim: DataFrame, width: str = vwap.WINDOW, **thresholds: float
) -> DataFrame:
    """Anomalies with their messages, in two passes over the records.

    The first pass shuffles sums only and stores the anomalous windows in the shared folder; it runs
    when this function is called. The second one gathers the messages of those windows alone.
    """
    return _anomalies(records, market_stats(records, width), dim, width, **thresholds)


def anomaly_envelopes(records: DataFrame, dim: DataFrame, width: str = vwap.WINDOW) -> DataFrame:
    return vwap.anomaly_messages(price_anomalies(records, dim, width))
