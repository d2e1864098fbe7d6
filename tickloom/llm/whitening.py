"""Embedding whitening: principal components by contour integration, and every row on them.

Entries become whole numbers x = floor(scale * c). Covariances are taken over the fit list, each distinct x
vector once, centred before multiplying: tasks add up centred outer products, one d x d sum each, and
these are added row by row in a second stage. What reaches the driver has the size of one covariance
matrix, whatever the number of rows. The components are found by :mod:`tickloom.llm.feast`, one task for
each interval of eigenvalues.

Defined results: vectors that are NULL or hold a NULL, NaN or infinite entry, or one beyond 62 bits after
scaling, take no part; of vectors of several lengths only those of the commonest length (the longer
one of two) do. A component without variance cannot be whitened and is not returned: no rows for an
empty table or where all vectors are equal. A deviation beyond 64 bits is NULL. Equal eigenvalues: any
orthonormal vectors of their space, the same for all rows; each vector's largest entry is positive.
Rows with the same id, NULL ids too, are rows of their own. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import feast
from tickloom.session import store

SCALE = 256
COMPONENTS = 4
# Rows of a block in memory.
BLOCK = 4096
SAFE = float(1 << 62)


@dataclass(frozen=True)
class Fit:
    """Number of vectors and sums by dimension, exact; components as columns, their eigenvalues, the trace."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ (self.vectors / np.sqrt(self.values))


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x minus the mean, unrounded: the whole part of the mean is taken off in whole numbers."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole) - rest


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sums over the dimensions of (n * x - S)^2, exact; None beyond 64 bits."""
    scaled = x.astype(float) * n
    rough = scaled - np.array(sums, dtype=float)
    safe = (np.abs(scaled).max(axis=1) < SAFE) & ((rough**2).sum(axis=1) < SAFE) & (max(map(abs, sums)) < SAFE)
    out: list[int | None] = [None] * len(x)
    if safe.any():
        exact = ((x[safe] * n - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1)
        for at, value in zip(np.flatnonzero(safe).tolist(), exact.tolist(), strict=True):
            out[at] = value
    for at in np.flatnonzero(~safe).tolist():
        value = sum((n * int(c) - s) ** 2 for c, s in zip(x[at], sums, strict=True))
        out[at] = value if value < 1 << 63 else None
    return out


def _blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            flat = part.column(column).flatten().to_numpy(zero_copy_only=False)
            yield part, flat.reshape(part.num_rows, -1)


# --- vectors and their moments ------------------------------------------------------------------


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id, x`` of the vectors that take part."""
    cells = F.col(vector)
    scaled = F.transform(cells, lambda c: F.lit(float(scale)) * c.cast("double"))
    # NaN is larger than every number.
    good = cells.isNotNull() & F.forall(scaled, lambda c: F.coalesce(F.abs(c) < SAFE, F.lit(False)))
    return rows.filter(good).select(F.col(id_col).alias("vec_id"), F.transform(scaled, lambda c: F.floor(c).cast("long")).alias("x"))


def _of_common_length(vectors: DataFrame) -> DataFrame:
    lengths = vectors.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return vectors.filter(F.size("x") == (common["d"] if common else 0))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: the sum of each dimension and, at -1, the number of vectors; as text, so that nothing overflows."""
    n, sums = 0, None
    for _, x in _blocks(batches, 0):
        exact = x if float(np.abs(x.astype(float)).max(initial=0)) * len(x) < SAFE else x.astype(object)
        part = [int(v) for v in exact.sum(axis=0)]
        sums = part if sums is None else [a + b for a, b in zip(sums, part, strict=True)]
        n += len(x)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(sums)), pa.int32()), pa.array([str(v) for v in (n, *sums)])], ["at", "value"])


def first_moments(fit: DataFrame) -> tuple[int, tuple[int, ...]]:
    parts = fit.select("x").mapInArrow(_sums, "at int, value string")
    total = parts.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    known = {r["at"]: int(r["value"]) for r in total.collect()}  # one row for each dimension
    n = known.pop(-1, 0)
    return n, tuple(known[i] for i in range(len(known)))


def _line_batch(matrix: dict[int, np.ndarray]) -> pa.RecordBatch:
    lines = pa.array([line.tolist() for line in matrix.values()], pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array(list(matrix), pa.int32()), lines], ["at", "line"])


def covariance(fit: DataFrame, n: int, centre: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Mean of the outer products of ``centre(x)``, vectors whose mean is 0."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _blocks(batches, 0):
            c = centre(x)
            total = c.T @ c if total is None else total + c.T @ c
        if total is not None:
            yield _line_batch(dict(enumerate(total)))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, line in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = line.values.to_numpy(zero_copy_only=False)
                lines[at] = lines[at] + values if at in lines else values
        if lines:
            yield _line_batch(lines)

    schema = "at int, line array<double>"
    parts = fit.select("x").mapInArrow(products, schema)
    whole = parts.repartition("at").mapInArrow(added, schema)
    rows = {r["at"]: r["line"] for r in whole.collect()}  # one row for each dimension
    matrix = np.array([rows[i] for i in range(len(rows))]) / n
    return (matrix + matrix.T) / 2


# --- components ---------------------------------------------------------------------------------


def components(spark, matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues and their vectors, as far as they are above rounding level; each interval of
    eigenvalues is one task."""
    found = feast.intervals(matrix, k)
    shared = spark.sparkContext.broadcast(matrix)  # d x d numbers

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                values, vectors = feast.eigenpairs(shared.value, row.low, row.high, row.count_inside)
                yield pd.DataFrame({"value": values, "vector": list(vectors.T)})

    table = [(float(low), float(high), int(count)) for low, high, count in found]
    rows = spark.createDataFrame(table, "low double, high double, count_inside int").repartition(len(table))
    pairs = sorted(rows.mapInPandas(solve, "value double, vector array<double>").collect(), key=lambda r: -r["value"])
    if len(pairs) != sum(count for _, _, count in table):
        raise ArithmeticError("the inertia counts do not agree with the eigenvalues found")
    level = len(matrix) * feast.EPS * float(np.trace(matrix))
    pairs = [r for r in pairs[:k] if r["value"] > level]
    vectors = np.array([r["vector"] for r in pairs]).reshape(len(pairs), len(matrix)).T
    return np.array([r["value"] for r in pairs]), vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), range(len(pairs))])


def fitted(vectors: DataFrame, k: int = COMPONENTS) -> Fit | None:
    """The components of the distinct vectors; None without any that has variance."""
    fit = store(vectors.select("x").distinct(), "fit")
    n, sums = first_moments(fit)
    if n == 0 or not sums:
        return None
    matrix = covariance(fit, n, lambda x: centred(x, n, sums))
    if not matrix.any():
        return None
    values, basis = components(vectors.sparkSession, matrix, k)
    rough = Fit(n, sums, values, basis, float(np.trace(matrix)), 0.0)
    white = covariance(fit, n, rough.whiten)
    return Fit(n, sums, values, basis, rough.trace, float(np.abs(white - np.eye(len(values))).max()))


def whitened(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``vec_id, component`` (from 1) ``, n, deviation, whitened, explained, identity_error``: each row on the k
    largest components."""
    vectors = _of_common_length(store(whole_vectors(rows, id_col, vector, scale), "vectors"))
    schema = (
        f"vec_id {dict(vectors.dtypes)['vec_id']}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    fit = fitted(vectors, k)
    if fit is None:
        return rows.sparkSession.createDataFrame([], schema)
    shares = fit.values / fit.trace

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, 1):
            white, far = fit.whiten(x), deviations(x, fit.n, fit.sums)
            rows, most = white.shape
            each = np.repeat(np.arange(rows), most)
            columns = [
                part.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, most + 1), rows), pa.int32()),
                pa.array(np.full(rows * most, fit.n), pa.int64()),
                pa.array(far, pa.int64()).take(pa.array(each)),
                pa.array(white.ravel(), pa.float64()),
                pa.array(np.tile(shares, rows), pa.float64()),
                pa.array(np.full(rows * most, fit.identity_error), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(place, schema)
