"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Read in this order. The first can be set at any time, the second only before a session starts.
SHARED_KEYS = ("spark.tickloom.shared", "spark.checkpoint.dir")


def build_session(
    app: str = "tickloom", zone: str = "Asia/Seoul", shared: str | None = None, **conf: str
) -> SparkSession:
    """A session in the market's time zone. Extra settings are given as ``spark__x__y="v"``.

    ``shared`` is a folder that the driver and all executors see; it may be left out where the
    cluster names one in ``spark.checkpoint.dir``. Shuffle width is left to the cluster
    (``spark.sql.shuffle.partitions``); adaptive execution merges small partitions and splits skewed
    ones. State lives in RocksDB, off the JVM heap.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", zone)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    if shared is not None:
        builder = builder.config(SHARED_KEYS[0], shared)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, as the session names it."""
    for key in SHARED_KEYS:
        root = spark.conf.get(key, None)
        if root:
            return root.rstrip("/")
    raise ValueError(
        f"no shared folder: set {SHARED_KEYS[1]} before the session starts, or "
        f'spark.conf.set("{SHARED_KEYS[0]}", folder), to a folder that all executors see'
    )


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def store(rows: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write rows to the shared folder and read them from there: for results that several branches
    of a plan use and that are costly to compute again. ``compression`` is the session's unless given."""
    path = run_folder(rows.sparkSession, name)
    rows.write.parquet(path, compression=compression)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
