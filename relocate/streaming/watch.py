"""Watches over staged files: what was announced against what landed, and loads that got stuck.

Both gather the signs of a file into episodes: signs that follow one another within a waiting time belong together.
An episode is closed, and comes out once, when the watermark has passed its last sign by that time. Until then the state
holds one row a file. Streams and batches give the same episodes however the signs are split; only signs older than the
watermark are left out. Of a table read as a batch every episode comes out, the open ones included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relocate.functions import paths
from relocate.operators import ledger

LANDED, MISSING, UNANNOUNCED = "landed", "never landed", "not announced"


def _instant(time: Column) -> Column:
    """A wall-clock time as an instant, whatever the session's zone."""
    seconds = F.extract(F.lit("SECONDS"), time)
    parts = [F.year(time), F.month(time), F.day(time), F.hour(time), F.minute(time)]
    return F.make_timestamp(*parts, seconds, F.lit("UTC"))


def _marked(signs: DataFrame, time: str, delay: str) -> DataFrame:
    return signs.withColumn("_at", _instant(F.col(time))).withWatermark("_at", delay)


def arrivals(announced: DataFrame, landed: DataFrame, wait: str, delay: str) -> DataFrame:
    """Announced files against landed ones: one row per file and episode, with its ``outcome``.

    ``announced`` has ``task_name, announced_at`` and ``landed`` has ``task_name, landed_at``, wall-clock times in one
    zone; both are streams, or both tables. Repeated signs are counted and the first of each kind is shown. Names are
    compared without their scheme. Rows without name or time are left out. The slower stream moves the watermark, so a
    listing that lags reports nothing as missing; after a restart it moves once both streams have had new signs.
    """
    none = F.lit(None).cast("timestamp_ntz")
    said = _marked(announced, "announced_at", delay).select("task_name", "_at", "announced_at", none.alias("landed_at"))
    seen = _marked(landed, "landed_at", delay).select("task_name", "_at", none.alias("announced_at"), "landed_at")
    signs = said.unionByName(seen).where(F.col("task_name").isNotNull() & F.col("_at").isNotNull())
    outcome = F.when(F.col("landed_at").isNull(), MISSING).when(F.col("announced_at").isNull(), UNANNOUNCED)
    return (
        signs.groupBy(paths.same_file("task_name").alias("file"), F.session_window("_at", wait))
        .agg(
            F.min("task_name").alias("task_name"),
            F.min("announced_at").alias("announced_at"),
            F.min("landed_at").alias("landed_at"),
            F.count("announced_at").alias("announcements"),
            F.count("landed_at").alias("landings"),
        )
        .select(
            "task_name", "announced_at", "landed_at", "announcements", "landings", outcome.otherwise(LANDED).alias("outcome")
        )
    )


def stuck_loads(events: DataFrame, limit: str, delay: str) -> DataFrame:
    """A RETRY event for each file whose load was begun and gave no sign within ``limit``.

    ``events`` are those of a ledger. The new event is dated where the time ran out and keeps the load's id, so the next
    import finishes that very load. It depends on the ledger alone: raising it again changes nothing.
    """
    signs = _marked(events, "update_time", delay).where(F.col("task_name").isNotNull() & F.col("_at").isNotNull())
    last = F.max_by(F.struct("status", "update_time", "seq", "load_id"), F.struct("update_time", "seq")).alias("last")
    return (
        signs.groupBy("task_name", F.session_window("_at", limit))
        .agg(last)
        .where(F.col("last.status") == ledger.LOADING)
        .select(
            "task_name",
            F.lit(ledger.RETRY).alias("status"),
            (F.col("last.update_time") + F.expr(f"INTERVAL {limit}")).alias("update_time"),
            F.col("last.seq").alias("seq"),
            F.lit(f"no outcome within {limit}").alias("msg"),
            F.col("last.load_id").alias("load_id"),
        )
    )


def record_report(report: DataFrame, folder: str, checkpoint: str, drain: bool = True):
    """Write closed episodes to Parquet files below ``folder``, each once, also when a micro-batch is replayed."""
    writer = report.writeStream.outputMode("append").format("parquet").option("path", folder)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer).start()


def raise_retries(stuck: DataFrame, record: ledger.Ledger, checkpoint: str, drain: bool = True):
    """Add the events of ``stuck_loads`` to a ledger; those that it holds already, from a replayed batch, are left out."""

    def add(batch: DataFrame, batch_id: int) -> None:
        raised = record.events().where(F.col("status") == ledger.RETRY)
        new = batch.join(raised, ["task_name", "status", "update_time", "seq"], "left_anti")
        new.write.mode("append").parquet(record.folder)

    writer = stuck.writeStream.outputMode("append").foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer).start()
