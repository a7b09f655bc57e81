"""Work messages, job texts and load labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON layouts of work messages, storage events and export-job details.
MESSAGE_SCHEMA = "task_name string, update_time string, status string"
STORAGE_EVENT_SCHEMA = (
    "Records array<struct<s3: struct<bucket: struct<name: string>, object: struct<key: string>>>>"
)
TASK_INFO_SCHEMA = "tbl string, partitions array<string>"

# Fixed value: the task name that ends a job.
END_MARKER = "ALL TASK DONE"

# Fixed value: how a load without rows reports itself.
NO_DATA_ENDING = "all partitions have no load data"


def message_body(task_name: Column, update_time: Column, status: Column) -> Column:
    return F.to_json(
        F.struct(task_name.alias("task_name"), update_time.alias("update_time"), status.alias("status"))
    )


def parsed_message(body: Column) -> Column:
    return F.from_json(body, MESSAGE_SCHEMA)


def task_info(text: Column) -> tuple[Column, Column]:
    """Table and first partition of an export job's JSON details."""
    info = F.from_json(text, TASK_INFO_SCHEMA)
    return info["tbl"], F.get(info["partitions"], F.lit(0))


def job_summary(job: Column, query: Column, table: Column, partition: Column) -> Column:
    return F.concat_ws("_", job, query, table, partition)


def load_summary(label: Column, state: Column, message: Column) -> Column:
    return F.concat(label, F.lit(":"), state, F.lit("==>"), F.coalesce(message, F.lit("")))


def load_label(job: Column, table: Column, file: Column) -> Column:
    """Same file, same label: a repeated load can be recognised."""
    return F.concat_ws("_", table, F.left(F.sha2(F.concat_ws("#", job, table, file), 256), F.lit(32)))


def failure_severity(ok: Column, message: Column) -> Column:
    """``OK``, ``EMPTY`` for a load that found no rows (a warning, still no success) or ``ERROR``."""
    return (
        F.when(ok, "OK")
        .when(F.coalesce(message, F.lit("")).endswith(NO_DATA_ENDING), "EMPTY")
        .otherwise("ERROR")
    )
