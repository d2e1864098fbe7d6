"""Compare a query with its SQL in DuckDB, row by row."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(value)


def rows_of_frame(frame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(_plain(v) for v in row) for row in frame.astype(object).itertuples(index=False, name=None))


def compare(spark_rows, sql_rows) -> str:
    """Empty text if both pandas frames hold the same rows and types, else what differs."""
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} != {sorted(sql_rows.columns)}"
    for name in spark_rows.columns:
        a, b = spark_rows[name].dtype, sql_rows[name].dtype
        if a != b and not (str(a) in ("object", "str", "string") and str(b) in ("object", "str", "string")):
            return f"type of {name}: {a} != {b}"
    left, right = rows_of_frame(spark_rows), rows_of_frame(sql_rows)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    for a, b in zip(left, right):
        if a != b:
            return f"{a} != {b}"
    return ""
