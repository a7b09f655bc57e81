"""The task ledger: status events per staged file, folded to the latest state.

An event has ``task_name, status, update_time, seq, msg, load_id``. Events are only ever
added; the state of a file is its latest event by ``(update_time, seq)``. Times are UTC, so
their order depends on no session zone.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relocate.functions import messages, paths, times
from relocate.session import read_or_empty, saved

# States of a staged file.
EXPORTING = "exporting"
UPLOADED = "file uploaded to s3"
LOADING = "IMPORTING"
LOADED = "IMPORTED SUCCESSFULLY"
FAILED = "IMPORTED FAILED"
RETRY = "IMPORTED RETRY"

# State of a file whose job was purged; such files are no longer shown.
PURGED = "PURGED"

# States of an export job.
PENDING_JOB, EXPORTING_JOB, FINISHED_JOB, CANCELLED_JOB = "PENDING", "EXPORTING", "FINISHED", "CANCELLED"

EVENT_SCHEMA = "task_name string, status string, update_time timestamp_ntz, seq bigint, msg string, load_id string"


def current_state(events: DataFrame) -> DataFrame:
    """Latest event of each file, one partial row per file and task before the shuffle."""
    fields = [column for column in events.columns if column not in ("task_name", "seq")]
    latest = F.max_by(F.struct(*fields), F.struct("update_time", "seq"))
    return events.groupBy("task_name").agg(latest.alias("_latest")).select("task_name", "_latest.*")


def scan(ledger: DataFrame, prefix: str, without: str | None = None) -> DataFrame:
    """Entries below a path prefix, optionally leaving out one status. The prefix is closed with a slash."""
    kept = paths.below(F.col("task_name"), prefix)
    if without is not None:
        kept = kept & ~F.col("status").eqNullSafe(F.lit(without))
    return ledger.where(kept)


def loaded_by(events: DataFrame) -> DataFrame:
    """``(task_name, load_id)``: the last load that took each file, whatever happened to the file since."""
    done = events.where((F.col("status") == LOADED) & F.col("load_id").isNotNull())
    return done.groupBy("task_name").agg(F.max_by("load_id", F.struct("update_time", "seq")).alias("load_id"))


def progress(state: DataFrame) -> DataFrame:
    """Per job: files loaded and files not loaded."""
    ok = F.col("status") == LOADED
    return state.groupBy(paths.job_of("task_name").alias("job")).agg(
        F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed")
    )


def job_files(state: DataFrame, job: str) -> DataFrame:
    """Files of a job, told by the job segment of their path."""
    return state.where(paths.job_of("task_name") == F.lit(job))


def failed_files(state: DataFrame, job: str) -> DataFrame:
    """Files of a job whose load did not succeed."""
    return job_files(state, job).where(~F.col("status").eqNullSafe(F.lit(LOADED)))


def folder_files(state: DataFrame, partition: str) -> DataFrame:
    """Files in the folder of a partition, whose name may be percent-encoded in their paths."""
    return state.where(paths.folder_value("task_name") == partition)


def pending_files(landed: DataFrame, state: DataFrame) -> DataFrame:
    """Landed files that the ledger does not show as loaded."""
    return landed.join(state.where(F.col("status") == LOADED), "task_name", "left_anti")


def unloaded_files(landed: DataFrame, state: DataFrame) -> DataFrame:
    """Landed files that are not loaded, with ``load_id`` where a load of theirs was begun and not finished."""
    begun = F.col("status").isin(LOADING, FAILED, RETRY)  # a RETRY names a load only where one got stuck
    return (
        landed.select("task_name")
        .join(state.select("task_name", "status", "load_id"), "task_name", "left")
        .where(~F.col("status").eqNullSafe(F.lit(LOADED)))
        .select("task_name", F.when(begun, F.col("load_id")).alias("load_id"))
    )


def work_messages(files: DataFrame, status: str | Column, update_time: Column) -> DataFrame:
    """A JSON message for each file."""
    status = F.lit(status) if isinstance(status, str) else status
    body = messages.message_body(F.col("task_name"), times.status_time(update_time), status)
    return files.select("task_name", body.alias("body"))


def message_fields(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Parsed messages with the job that each belongs to; an end marker names its job in ``status``."""
    parsed = bodies.select(messages.parsed_message(F.col(body)).alias("m")).select("m.*")
    is_end = F.col("task_name") == messages.END_MARKER
    return parsed.withColumn("is_end", is_end).withColumn(
        "job", F.when(is_end, F.col("status")).otherwise(paths.job_of("task_name"))
    )


def done_marker_counts(bodies: DataFrame) -> DataFrame:
    """End markers per job."""
    return message_fields(bodies).where("is_end").groupBy("job").agg(F.count("*").alias("markers"))


def job_states(rows: DataFrame) -> DataFrame:
    """Latest state of each export query, and whether it still runs.

    ``rows`` has ``query_id, job_id, state, task_info, error_msg, ts, seq``.
    """
    latest = F.max_by(F.struct("job_id", "state", "task_info", "error_msg"), F.struct("ts", "seq"))
    table, partition = messages.task_info(F.col("task_info"))
    return rows.groupBy("query_id").agg(latest.alias("_latest")).select("query_id", "_latest.*").select(
        "query_id",
        "state",
        F.col("state").isin(PENDING_JOB, EXPORTING_JOB).alias("running"),
        messages.job_summary(F.col("job_id"), F.col("query_id").cast("string"), table, partition).alias("summary"),
        F.col("error_msg").alias("msg"),
    )


def running_jobs(states: DataFrame) -> DataFrame:
    """Number of export queries that still run."""
    return states.agg(F.count_if("running").alias("running_jobs"), F.count("*").alias("jobs"))


class Ledger:
    """A ledger kept as Parquet files below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def events(self) -> DataFrame:
        return read_or_empty(self.spark, self.folder, EVENT_SCHEMA)

    def current(self) -> DataFrame:
        return current_state(self.events()).where(F.col("status") != PURGED)

    def history(self) -> DataFrame:
        """All events of files that are not purged."""
        gone = current_state(self.events()).where(F.col("status") == PURGED)
        return self.events().join(gone, "task_name", "left_anti")

    def hold(self, files: DataFrame) -> DataFrame:
        """Fix the outcome of a query on the ledger before the ledger changes under it."""
        return saved(files, "ledger-hold")

    def append(self, files: DataFrame, status: str, msg: str | Column = "", load_id: str | Column | None = None) -> None:
        """Add one event per file."""
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        files.select(
            "task_name",
            F.lit(status).alias("status"),
            F.lit(now.isoformat(" ")).cast("timestamp_ntz").alias("update_time"),
            F.lit(time.time_ns()).alias("seq"),
            (F.lit(msg) if isinstance(msg, str) else msg).alias("msg"),
            (load_id if isinstance(load_id, Column) else F.lit(load_id)).cast("string").alias("load_id"),
        ).write.mode("append").parquet(self.folder)

    def purge(self, folder: str) -> None:
        """Drop the files below a job's stage folder from the ledger."""
        self.append(self.hold(scan(self.current(), folder)), PURGED)
