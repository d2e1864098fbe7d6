"""The sector file: a JSON array of ``{stock_code, name, sectors[]}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.layouts import SECTOR_ENTRY
from tickloom.operators.sectors import sector_rows, validity


def read_sectors(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """One row per (stock, sector). ``multiline`` reads a JSON array or object spread over lines;
    turn it off for files with one object per line, which Spark can split."""
    entries = spark.read.schema(SECTOR_ENTRY).option("multiline", multiline).json(path)
    return sector_rows(entries)


def read_sector_history(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """All sector files ever fetched, in folders ``valid_from=<time>``, as validity intervals."""
    schema = T.StructType([*SECTOR_ENTRY.fields, T.StructField("valid_from", T.TimestampType())])
    entries = spark.read.schema(schema).option("multiline", multiline).json(path)
    rows = entries.select("stock_code", F.explode("sectors").alias("sector"), "name", "valid_from")
    return validity(rows)


def write_sectors(entries: DataFrame, path: str) -> None:
    """Write ``stock_code, name, sectors`` as JSON, one object per line, with ``part`` where a stock has
    several rows."""
    part = [name for name in ("part",) if name in entries.columns]
    entries.select("stock_code", "name", "sectors", *part).write.mode("overwrite").json(path)
