"""The original messages behind anomalous windows, in lists of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.joins import BROADCAST_LIMIT, is_small
from tickloom.operators.vwap import WINDOW

# About so many bytes of messages in one list; well below the size of record that a broker takes.
LIST_BYTES = 256 * 1024
ROWS_PER_SLICE = 1_000_000


def _parts(list_bytes: int) -> Column:
    """Number of lists a window needs."""
    return F.greatest(F.ceil(F.col("message_bytes") / list_bytes), F.lit(1)).cast("int")


def _same_window(a: str, b: str, *more: str) -> Column:
    """Windows of one stock; a missing stock code is a stock of its own."""
    condition = F.col(f"{a}.window") == F.col(f"{b}.window")
    for name in ("stock_code", *more):
        condition = condition & F.col(f"{a}.{name}").eqNullSafe(F.col(f"{b}.{name}"))
    return condition


def _complete(windows: DataFrame, lists: DataFrame, list_bytes: int) -> DataFrame:
    """Every window in all of its parts, whether or not messages were found for them."""
    wanted = windows.withColumn("parts", _parts(list_bytes)).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    totals = lists.groupBy("window", "stock_code").agg(F.sum(F.size("raw_messages")).alias("found"))
    joined = (
        wanted.alias("w")
        .join(lists.alias("l"), _same_window("w", "l", "part"), "left")
        .join(totals.alias("t"), _same_window("w", "t"), "left")
    )
    return joined.select(
        "w.*",
        F.coalesce("l.raw_messages", F.array().cast("array<string>")).alias("raw_messages"),
        (F.coalesce("t.found", F.lit(0)) >= F.col("w.message_count")).alias("messages_complete"),
    )


def with_messages(
    windows: DataFrame,
    trades: DataFrame,
    width: str = WINDOW,
    spread_on: Sequence[str] = ("partition", "offset"),
    list_bytes: int = LIST_BYTES,
    rows_per_slice: int = ROWS_PER_SLICE,
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """The given windows with their messages: ``raw_messages, part, parts, messages_complete`` added.

    ``windows`` (with ``window, stock_code, message_count, message_bytes``) are the few windows in
    question, so only their messages are gathered, not those of all windows. They are measured and should
    be stored or cached: below ``limit`` bytes they are broadcast and all other trades are dropped before
    any shuffle. Beyond that the join shuffles, each window cut into as many slices as its messages need.

    A window always gives ``parts`` rows, one for each ``list_bytes`` of its messages; ``part`` counts
    them. No window is lost: one whose messages are not (all) in ``trades`` has lists that are empty or
    short, and ``messages_complete`` is false.
    """
    wanted = windows.select("window", "stock_code", "message_count", _parts(list_bytes).alias("parts"))
    spread = F.xxhash64(*spread_on)
    timed = trades.select(
        F.window("timestamp", width).alias("window"),
        "stock_code",
        "original_message",
        spread.alias("spread"),
    )
    # Measured without what is not broadcast.
    few = windows.select(F.col("window.start").alias("start"), "stock_code", _parts(list_bytes).alias("parts"))
    if is_small(few, limit):
        same = (F.col("t.window.start") == F.col("w.start")) & F.col("t.stock_code").eqNullSafe(F.col("w.stock_code"))
        found = timed.alias("t").join(F.broadcast(few).alias("w"), same)
    else:
        # Slices by the size of each window; small windows stay whole.
        cuts = F.greatest(F.ceil(F.col("message_count") / rows_per_slice), F.lit(1)).cast("int")
        sliced = wanted.withColumn("cuts", cuts)
        hot = sliced.filter("cuts > 1").select("window", "stock_code", "cuts")
        marked = timed.alias("t").join(F.broadcast(hot).alias("h"), _same_window("t", "h"), "left")
        rows = marked.select("t.*", F.pmod("spread", F.coalesce("cuts", F.lit(1))).cast("int").alias("slice"))
        every = sliced.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
        found = rows.alias("t").join(every.alias("w"), _same_window("t", "w", "slice"))
    part = F.pmod(F.shiftrightunsigned("spread", 16), F.col("parts")).cast("int")
    lists = (
        found.select("t.window", "t.stock_code", part.alias("part"), "original_message")
        .groupBy("window", "stock_code", "part")
        .agg(F.collect_list("original_message").alias("raw_messages"))
    )
    return _complete(windows, lists, list_bytes)


def with_sliced_messages(windows: DataFrame, sliced: DataFrame, list_bytes: int = LIST_BYTES) -> DataFrame:
    """The same from sub-groups that kept their messages (:func:`vwap.window_sums` with ``slices``)."""
    wanted = windows.select("window", "stock_code", _parts(list_bytes).alias("parts"))
    kept = sliced.select("window", "stock_code", "slice", "raw_messages")
    found = kept.alias("t").join(wanted.alias("w"), _same_window("t", "w"))
    each = found.select("t.window", "t.stock_code", "parts", "slice", F.posexplode("raw_messages").alias("at", "message"))
    part = F.pmod(F.xxhash64("slice", "at"), F.col("parts")).cast("int")
    lists = (
        each.select("window", "stock_code", part.alias("part"), "message")
        .groupBy("window", "stock_code", "part")
        .agg(F.collect_list("message").alias("raw_messages"))
    )
    return _complete(windows, lists, list_bytes)
