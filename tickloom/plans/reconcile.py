"""What the watermark dropped: the stream's report held against the archive, and put right.

A stream reports a window once; records that come later are dropped. The archive has them. Counting
its records per window needs neither parsing nor messages; only windows whose counts differ are computed
again, from their own records alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.clock import iso_text
from tickloom.operators import vwap
from tickloom.operators.joins import is_small
from tickloom.operators.trades import parse_trades
from tickloom.session import store

#: What a difference means.
MISSING, LATE, BEHIND = "not reported", "late records dropped", "archive behind"


def _same_window(a: str, b: str) -> Column:
    """Windows of one stock; a missing stock code is a stock of its own."""
    return (F.col(f"{a}.update_time") == F.col(f"{b}.update_time")) & F.col(f"{a}.stock_code").eqNullSafe(F.col(f"{b}.stock_code"))


def window_counts(records: DataFrame, width: str = vwap.WINDOW) -> DataFrame:
    """Records per window and stock: ``window, update_time, stock_code, archived``."""
    keys = [F.window("timestamp", width).alias("window"), F.col("key").cast("string").alias("stock_code")]
    counts = records.groupBy(*keys).agg(F.count("*").alias("archived"))
    return counts.withColumn("update_time", iso_text(F.col("window.start")))


def differences(reported: DataFrame, records: DataFrame, width: str = vwap.WINDOW) -> DataFrame:
    """Windows whose reported ``message_count`` is not the number of their records in the archive:
    ``update_time, stock_code, message_count, archived, reason`` and ``window`` (NULL if nothing is archived).

    ``reported`` has one row per ``update_time, stock_code``. Both sides are joined in full, so windows
    that stand on one side only are among them."""
    counts = window_counts(records, width)
    joined = reported.select("update_time", "stock_code", "message_count").alias("r").join(counts.alias("c"), _same_window("r", "c"), "full")
    told, kept = F.coalesce("r.message_count", F.lit(0)), F.coalesce("c.archived", F.lit(0))
    reason = F.when(F.col("r.update_time").isNull(), MISSING).when(kept > told, LATE).otherwise(BEHIND)
    there = F.col("r.update_time").isNotNull()
    return joined.filter(told != kept).select(
        F.coalesce("r.update_time", "c.update_time").alias("update_time"),
        F.when(there, F.col("r.stock_code")).otherwise(F.col("c.stock_code")).alias("stock_code"),
        told.alias("message_count"),
        kept.alias("archived"),
        reason.alias("reason"),
        "c.window",
    )


def corrections(found: DataFrame, records: DataFrame, width: str = vwap.WINDOW) -> DataFrame:
    """Statistics of the windows in ``found`` (from :func:`differences`, stored) of which the archive has more than
    was reported, computed from their records only.

    The records are bounded by the time range of these windows, a filter that reaches the scan, and joined
    with the windows before anything is parsed or shuffled, as long as the windows are few."""
    wrong = found.filter(F.col("reason") != BEHIND).select("window", "stock_code")
    start, end = wrong.agg(F.min("window.start"), F.max("window.end")).first()
    time = records.schema["timestamp"].dataType
    between = F.lit(False)
    if start is not None:
        between = (F.col("timestamp") >= F.lit(start).cast(time)) & (F.col("timestamp") < F.lit(end).cast(time))
    wanted = F.broadcast(wrong) if is_small(wrong) else wrong
    timed = records.filter(between).withColumn("_window", F.window("timestamp", width))
    inside = (F.col("_window") == F.col("w.window")) & F.col("t.key").cast("string").eqNullSafe(F.col("w.stock_code"))
    rows = timed.alias("t").join(wanted.alias("w"), inside, "left_semi").drop("_window")
    return vwap.window_stats(vwap.window_sums(parse_trades(rows), width))


def corrected(reported: DataFrame, records: DataFrame, width: str = vwap.WINDOW) -> DataFrame:
    """The report with every window that the archive knows better replaced or put in. Where the archive has
    less than was reported, the report stands. Columns are those of ``reported``: window statistics and, if it
    has one, ``report_date``."""
    found = store(differences(reported, records, width), "differences")
    right = store(corrections(found, records, width).withColumn("report_date", F.to_date(F.col("window.start"))), "corrections")
    keys = right.select("update_time", "stock_code")
    kept = reported.alias("r").join(keys.alias("k"), _same_window("r", "k"), "left_anti")
    return kept.unionByName(right.select(*reported.columns))


def correct_table(table: DataFrame, records: DataFrame, path: str, width: str = vwap.WINDOW, day: str = "report_date") -> DataFrame:
    """Write the days that change anew into ``path``, a table in folders by ``day``, and return the differences.

    ``table`` has the report's rows of that path, one per window and stock, with ``message_count`` and ``day``
    (NULL days are not touched). Days without a difference are neither read again nor written. New
    versions of the days are stored first, as a folder cannot be read while it is written."""
    found = store(differences(table, records, width), "differences")
    right = store(corrections(found, records, width).withColumn(day, F.to_date(F.col("window.start"))), "corrections")
    changed = right.select(day).distinct()  # one row for each day
    there = table.join(F.broadcast(changed), day, "left_semi")
    keys = right.select("update_time", "stock_code")
    kept = there.alias("r").join(keys.alias("k"), _same_window("r", "k"), "left_anti")
    days = store(kept.unionByName(right.select(*table.columns)), "days")
    writer = days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(day).parquet(path)
    return found
