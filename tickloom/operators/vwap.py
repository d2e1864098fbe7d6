"""Tumbling-window statistics per stock, the VWAP report, price anomalies and their messages.

Trades are aggregated per (window, stock) first and joined with the sectors afterwards: sector and
name depend on the stock only, so the rows are the same as for join-then-group, while the shuffle
and the state carry one row per window and stock. Partial aggregation absorbs hot stocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.clock import iso_text
from tickloom.functions.numbers import ratio
from tickloom.operators.trades import trade_numbers

# Window and lateness of the report, thresholds of an anomaly.
WINDOW = "30 seconds"
LATENESS = "1 minute"
SPREAD = 0.05
ABOVE_MEAN = 0.03

# Column names of the report and of anomalies.
REPORT_COLUMNS = ("update_time", "stock_code", "sector", "name", "vwap", "total_volume")
ANOMALY_COLUMNS = (
    "update_time",
    "stock_code",
    "sector",
    "name",
    "min_price",
    "avg_price",
    "max_price",
    "total_volume",
)
MESSAGE_FIELDS = (*ANOMALY_COLUMNS, "raw_messages", "part", "parts", "messages_complete")

# Whole numbers of 64 bits, their products and the sums of these.
EXACT = "decimal(38,0)"


def with_numbers(trades: DataFrame) -> DataFrame:
    return trades if "whole_price" in trades.columns else trade_numbers(trades)


def _whole(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def _sums(trades: DataFrame) -> list[Column]:
    """Sums that do not depend on how rows are grouped on the way: none overflows where 64 bits would."""
    size = F.octet_length("original_message") if "original_message" in trades.columns else F.lit(0)
    return [
        F.try_sum(F.try_multiply(_whole("whole_price"), _whole("volume")).try_cast(EXACT)).alias("sum_price_volume"),
        F.try_sum(_whole("volume")).alias("sum_volume"),
        F.min("whole_price").alias("min_price"),
        F.max("whole_price").alias("max_price"),
        F.try_sum("price").alias("sum_price"),
        F.count("price").alias("price_count"),
        F.count("*").alias("message_count"),
        F.sum(size).alias("message_bytes"),
    ]


def window_sums(
    trades: DataFrame,
    width: str = WINDOW,
    lateness: str | None = None,
    slices: int | None = None,
    spread_on: Sequence[str] = ("partition", "offset"),
) -> DataFrame:
    """Mergeable sums per (window, stock). With ``lateness`` the rows get a watermark (streams).

    With ``slices`` each group also keeps its messages, cut by a hash of ``spread_on`` into that
    many sub-groups, so that no single group or state entry holds all messages of a hot stock.
    """
    rows = with_numbers(trades)
    if lateness is not None:
        rows = rows.withWatermark("timestamp", lateness)
    keys = [F.window("timestamp", width), F.col("stock_code")]
    sums = _sums(rows)
    if slices is not None:
        keys.append(F.pmod(F.xxhash64(*spread_on), F.lit(slices)).cast("int").alias("slice"))
        sums.append(F.collect_list("original_message").alias("raw_messages"))
    return rows.groupBy(*keys).agg(*sums)


def merge_slices(sums: DataFrame) -> DataFrame:
    """Sums of sub-groups to sums per (window, stock); messages are left aside."""
    return sums.groupBy("window", "stock_code").agg(
        *[F.try_sum(name).alias(name) for name in ("sum_price_volume", "sum_volume", "sum_price")],
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        *[F.sum(name).alias(name) for name in ("price_count", "message_count", "message_bytes")],
    )


def window_stats(sums: DataFrame) -> DataFrame:
    """Add the mean price (fraction cut off), the VWAP, the volume and the window start as ISO text."""
    mean = F.expr("sum_price div nullif(price_count, 0)")
    return sums.withColumns(
        {
            "avg_price": mean,
            "vwap": ratio(F.col("sum_price_volume"), F.col("sum_volume")),
            "total_volume": F.col("sum_volume").try_cast("long"),
            "update_time": iso_text(F.col("window.start")),
        }
    )


def report(stats: DataFrame) -> DataFrame:
    """The VWAP report from enriched window statistics."""
    return stats.select(*REPORT_COLUMNS)


def anomalies(stats: DataFrame, spread: float = SPREAD, above_mean: float = ABOVE_MEAN) -> DataFrame:
    """Windows whose price range and peak over the mean both reach their thresholds."""
    top, low, mean = F.col("max_price"), F.col("min_price"), F.col("avg_price")
    return stats.filter((ratio(top - low, low) >= spread) & (ratio(top - mean, mean) >= above_mean))


def anomaly_rows(stats: DataFrame) -> DataFrame:
    extra = [name for name in ("raw_messages", "part", "parts", "messages_complete") if name in stats.columns]
    return stats.select(*ANOMALY_COLUMNS, *extra)


def anomaly_messages(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Kafka rows of anomalies: key = stock, value = JSON of the anomaly, its raw messages, which ``part`` of
    how many ``parts`` this is, and whether all messages were found. Members that are NULL are left out, as
    readers of the topic know it (a trade without stock code has no ``stock_code`` member)."""
    value = F.to_json(F.struct(*MESSAGE_FIELDS))
    return rows.select(F.col("stock_code").alias("key"), value.alias("value"), *keep)


def sector_sums() -> list[Column]:
    """Sums over the stocks of a sector; stocks are counted once per window of the report."""
    return [
        F.count("*").alias("stocks"),
        F.try_sum("sum_volume").alias("volume"),
        F.try_sum("sum_price_volume").alias("sector_price_volume"),
    ]


def sector_figures(sums: DataFrame, *keep: str) -> DataFrame:
    return sums.select(
        "update_time",
        "sector",
        "stocks",
        F.col("volume").try_cast("long").alias("sector_volume"),
        ratio(F.col("sector_price_volume"), F.col("volume")).alias("sector_vwap"),
        *keep,
    )


def sector_breakdown(stats: DataFrame) -> DataFrame:
    """The report per sector: stocks seen, volume, VWAP over the sector's stocks."""
    return sector_figures(stats.groupBy("update_time", "sector").agg(*sector_sums()))
