"""Files in the shared folder that Spark has no writer for."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme, as the cluster resolves it."""
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = given.getFileSystem(spark._jsc.hadoopConfiguration())
    full = system.makeQualified(given).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a qualified URI; works on executors for every store that Arrow knows."""
    return fs.FileSystem.from_uri(uri)
