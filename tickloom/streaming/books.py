"""What a stream has to remember between micro-batches beside its state: small tables that a batch replaces,
and which batch a sink has finished. Both withstand a batch that is repeated after a failure."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 2


class Versions:
    """A table of which each batch may write a new version.

    The last two versions are kept, in two folders that take turns, so nothing has to be deleted. A repeated
    batch reads what it read before (the last version below its own number) and writes where it wrote
    before. A version may be empty: a marker row stands for it.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path = spark, path
        self.schema = f"{schema}, _batch bigint, _slot int, _marker boolean"
        self.columns = [field.name for field in spark.createDataFrame([], schema).schema]
        self._marked(-1, 0).write.mode("ignore").parquet(f"{path}/slot-0")

    def _marked(self, batch_id: int, slot: int) -> DataFrame:
        nothing = [None] * len(self.columns)
        return self.spark.createDataFrame([(*nothing, batch_id, slot, True)], self.schema)

    def _all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/slot-*")

    def _last(self, below: int | None) -> tuple[int, int]:
        """Number and slot of the last version, below a batch if one is given."""
        markers = self._all().filter("_marker")
        if below is not None:
            markers = markers.filter(F.col("_batch") < below)
        batch, slot = markers.agg(F.max("_batch"), F.max_by("_slot", "_batch")).first()
        return (-1, 0) if batch is None else (batch, slot)

    def _version(self, batch_id: int, slot: int) -> DataFrame:
        """Read from its own folder alone, as the other one may be written meanwhile."""
        rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/slot-{slot}")
        return rows.filter((F.col("_batch") == batch_id) & ~F.col("_marker")).select(*self.columns)

    def last(self) -> int:
        """The batch that wrote last; -1 if none did."""
        return self._last(None)[0]

    def before(self, batch_id: int) -> DataFrame:
        return self._version(*self._last(batch_id))

    def at(self, batch_id: int) -> DataFrame:
        """The version of a batch, which has to be the last one up to it."""
        return self._version(*self._last(batch_id + 1))

    def holds(self, batch_id: int) -> bool:
        return bool(self._all().filter((F.col("_batch") == batch_id) & F.col("_marker")).head(1))

    def write(self, batch_id: int, rows: DataFrame | None = None) -> None:
        """``rows`` may come from :meth:`before`, which lies in the other folder."""
        slot = (self._last(batch_id)[1] + 1) % SLOTS
        version = self._marked(batch_id, slot)
        if rows is not None:
            tagged = rows.select(*self.columns, F.lit(batch_id).cast("long").alias("_batch"), F.lit(slot).alias("_slot"), F.lit(False).alias("_marker"))
            version = tagged.unionByName(version)
        version.write.mode("overwrite").parquet(f"{self.path}/slot-{slot}")


class Ledger:
    """Which batch each step has finished last. A step is done once for a batch, however often that runs: its
    entry, one row in one file, is written when it has returned."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.entries = spark, path, {}

    def _entry(self, step: str) -> Versions:
        if step not in self.entries:
            self.entries[step] = Versions(self.spark, f"{self.path}/{step}", "nothing int")
        return self.entries[step]

    def done(self, batch_id: int, step: str) -> bool:
        return self._entry(step).holds(batch_id)

    def once(self, batch_id: int, step: str, act: Callable[[], None]) -> None:
        if not self.done(batch_id, step):
            act()
            self._entry(step).write(batch_id)
