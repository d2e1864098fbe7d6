"""Makes this package importable on the workers, as ``--py-files`` does."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's sources to Spark's file server, once per application.

    The archive is read by the driver only; executors get it from Spark.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="tickloom-")) / "tickloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
