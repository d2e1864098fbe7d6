"""Kafka-shaped records to parsed trade rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.layouts import TRADE_MESSAGE
from tickloom.functions.numbers import to_decimal, to_long

CORRUPT = "_corrupt_record"


def on_day(records: DataFrame, day: Column | None = None, time_col: str = "timestamp") -> DataFrame:
    """Records of one day in the session zone; today unless a day is given.

    Catalyst turns the comparison into a time range that reaches the file scan.
    """
    return records.filter(F.to_date(F.col(time_col)) == (F.current_date() if day is None else day))


def parse_trades(records: DataFrame, keep: Sequence[str] = (), time_col: str = "timestamp") -> DataFrame:
    """The columns the report works on; ``keep`` names further record columns to carry along.

    A value that is not a JSON object gives a struct of NULLs and the row stays in its group.
    """
    text = F.col("value").cast("string")
    return records.select(
        F.col(time_col).alias("timestamp"),
        F.from_json(text, TRADE_MESSAGE).alias("data"),
        F.col("key").cast("string").alias("stock_code"),
        F.octet_length("value").alias("message_size_bytes"),
        text.alias("original_message"),
        *keep,
    )


def malformed_messages(records: DataFrame) -> DataFrame:
    """Records whose value is no JSON object of the expected form, with the ``reason``."""
    schema = T.StructType([*TRADE_MESSAGE.fields, T.StructField(CORRUPT, T.StringType())])
    data = F.from_json(F.col("value").cast("string"), schema, {"columnNameOfCorruptRecord": CORRUPT})
    return (
        records.withColumn("_data", data)
        .filter(F.col(f"_data.{CORRUPT}").isNotNull())
        .withColumn("reason", F.lit("bad_json"))
        .drop("_data")
    )


def trade_numbers(trades: DataFrame) -> DataFrame:
    """Add ``price`` (exact decimal), ``whole_price`` and ``volume`` (whole numbers)."""
    return trades.withColumns(
        {
            "price": to_decimal(F.col("data.stck_prpr")),
            "whole_price": to_long(F.col("data.stck_prpr")),
            "volume": to_long(F.col("data.cntg_vol")),
        }
    )


def trades_from_decoded(decoded: DataFrame, event_time: Column) -> DataFrame:
    """Decoded trade records as rows for the report, timed by ``event_time`` (such as the trade's
    own clock, :func:`tickloom.functions.clock.trade_instant`) in place of the broker's time."""
    return decoded.select(
        event_time.alias("timestamp"),
        "stock_code",
        F.col("stck_prpr").alias("price"),
        F.col("stck_prpr").try_cast("long").alias("whole_price"),
        F.col("cntg_vol").try_cast("long").alias("volume"),
    )
