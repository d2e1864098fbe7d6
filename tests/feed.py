"""Small hand-made feeds."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from tickloom.sources.records import RECORD

# The sample trade message of the feed.
REST = {
    "acml_vol": "10000",
    "acml_tr_pbmn": "100000000",
    "cttr": "100.00",
    "total_askp_rsqn": "5000",
    "total_bidp_rsqn": "5000",
}
START = datetime(2025, 7, 2, 0, 0, 0)


def message(price, volume) -> str:
    return json.dumps({"stck_prpr": str(price), "cntg_vol": str(volume), **REST})


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def record(stock: str | None, value: str, seconds: float, offset: int, topic: str = "H0STCNT0"):
    key = None if stock is None else bytearray(stock.encode())
    return (key, bytearray(value.encode()), topic, 0, offset, at(seconds))


def trades(*rows) -> list[tuple]:
    """Records of (stock, price, volume, seconds)."""
    return [record(stock, message(price, volume), seconds, n) for n, (stock, price, volume, seconds) in enumerate(rows)]


def records(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, RECORD)


def dim(spark: SparkSession, *rows) -> DataFrame:
    return spark.createDataFrame(list(rows), "stock_code string, sector string, name string")
