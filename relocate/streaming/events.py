"""Continuous ledger: status events from a stream of work messages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from relocate.operators import ledger


def stream_ledger(events: DataFrame, record: ledger.Ledger, checkpoint: str, drain: bool = True):
    """Add a stream of status events to a ledger.

    No state is kept per file: the latest event is folded when the ledger is read, and an
    event that is written again by a replayed micro-batch does not change it.
    """
    columns = [field.split()[0] for field in ledger.EVENT_SCHEMA.split(", ")]

    def add(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("append").parquet(record.folder)

    writer = events.select(*columns).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer).start()
