"""Publishing decoded records in their order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators import sequence
from tickloom.sources.sinks import Sink
from tickloom.streaming.books import Ledger, Versions


def start_publishing(
    rows: DataFrame, checkpoint: str, sink: Sink, books: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Publish ``topic, key, value`` rows (with their place ``partition, offset, record_no``) with a ``sequence``
    per key that holds over batches and restarts: a consumer can put messages in order, see gaps and drop
    repeats. Records that the source delivers again are left out.

    What is remembered is one row per key and source partition, in ``books`` beside the checkpoint. A batch
    that is repeated gives the same numbers.
    """
    spark = rows.sparkSession
    path = books or f"{checkpoint.rstrip('/')}-books"
    state, ledger = Versions(spark, f"{path}/sequence", sequence.STATE), Ledger(spark, f"{path}/ledger")

    def write(batch: DataFrame, batch_id: int) -> None:
        known = state.before(batch_id)
        fresh = sequence.fresh_rows(batch, known).persist()
        try:
            # Cached as a whole first: how its rows lie is known to the plans that follow.
            fresh.count()
            ledger.once(batch_id, "published", lambda: sink(sequence.with_sequence(fresh, known), batch_id))
            state.write(batch_id, sequence.next_state(fresh, known))
        finally:
            fresh.unpersist()

    writer = rows.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "0 seconds"})).start()
