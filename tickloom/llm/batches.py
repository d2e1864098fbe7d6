"""Arrow batches in pieces of bounded size, so that what a worker makes of them is bounded as well."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

SLICE_BYTES = 8 << 20
RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Documents in a batch on its way to a worker: of Spark's 10,000, each task holds some 40 MB in the JVM and again in the worker.
DOCUMENTS = 2_000


def short_batches(spark: SparkSession) -> None:
    """From now on no more than ``DOCUMENTS`` rows go to a worker at once, or fewer if the session says so."""
    most = int(spark.conf.get(RECORDS))
    if not 0 < most <= DOCUMENTS:
        spark.conf.set(RECORDS, DOCUMENTS)


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts in ``column`` have no more than ``most`` bytes together, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    upto = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = upto[start - 1] if start else 0
        end = max(int(np.searchsorted(upto, done + most, side="right")), start + 1)
        yield batch.slice(start, end - start)
        start = end
