"""The task ledger over the events table: fold, scans, retries, messages and job states."""

from pyspark.sql import functions as F

from relocate.checks import fixtures as fx
from relocate.checks import query
from relocate.functions import messages
from relocate.operators import ledger, load
from relocate.session import work_folder

_JOB = "split_part(task_name, '/', 5)"


def _state(spark, folder):
    return ledger.current_state(fx.ledger_events(spark, folder))


@query("ledger_current", fx.SQL_STATE)
def ledger_current(spark, folder):
    return _state(spark, folder).select("task_name", "status", "update_time")


@query(
    "ledger_scan",
    f"""
SELECT task_name, status FROM ({fx.SQL_STATE})
WHERE task_name LIKE 's3://b/stage/job1/%' AND status <> 'IMPORTED SUCCESSFULLY'""",
)
def ledger_scan(spark, folder):
    return ledger.scan(_state(spark, folder), "s3://b/stage/job1", ledger.LOADED).select("task_name", "status")


@query(
    "ledger_purge",
    f"SELECT task_name, status, update_time, seq FROM ({fx.SQL_LEDGER}) WHERE {_JOB} <> 'job1'",
)
def ledger_purge(spark, folder):
    record = ledger.Ledger(spark, work_folder(spark, "ledger"))
    fx.ledger_events(spark, folder).write.parquet(record.folder)
    record.purge("s3://b/stage/job1")
    return record.history().drop("msg", "load_id")


@query(
    "ledger_progress",
    f"""
SELECT {_JOB} AS job, CAST(count_if(status = 'IMPORTED SUCCESSFULLY') AS BIGINT) AS succeeded,
       CAST(count_if(status <> 'IMPORTED SUCCESSFULLY') AS BIGINT) AS failed
FROM ({fx.SQL_STATE}) GROUP BY 1""",
)
def ledger_progress(spark, folder):
    return ledger.progress(_state(spark, folder))


@query(
    "retry_failed",
    f"SELECT task_name FROM ({fx.SQL_STATE}) WHERE {_JOB} = 'job1' AND status <> 'IMPORTED SUCCESSFULLY'",
)
def retry_failed(spark, folder):
    return ledger.failed_files(_state(spark, folder), "job1").select("task_name")


@query("retry_all", f"SELECT task_name FROM ({fx.SQL_STATE}) WHERE {_JOB} = 'job1'")
def retry_all(spark, folder):
    return ledger.job_files(_state(spark, folder), "job1").select("task_name")


@query(
    "retry_partition",
    f"""
SELECT task_name FROM ({fx.SQL_STATE})
WHERE {_JOB} = 'job1' AND split_part(task_name, '/', 7) = 'tb' AND split_part(task_name, '/', 8) = 'p20240115'""",
)
def retry_partition(spark, folder):
    files = ledger.scan(_state(spark, folder), "s3://b/stage/job1/db/tb")
    return ledger.folder_files(files, "p20240115").select("task_name")


@query(
    "pending_files",
    f"""
SELECT task_name FROM (SELECT DISTINCT task_name FROM ({fx.SQL_LEDGER}) WHERE status = 'file uploaded to s3')
WHERE task_name NOT IN (SELECT task_name FROM ({fx.SQL_STATE}) WHERE status = 'IMPORTED SUCCESSFULLY')""",
)
def pending_files(spark, folder):
    events = fx.ledger_events(spark, folder)
    landed = events.where(F.col("status") == ledger.UPLOADED).select("task_name").distinct()
    return ledger.pending_files(landed, ledger.current_state(events))


@query(
    "work_messages",
    f"""
SELECT task_name, '{{"task_name":"' || task_name || '","update_time":"' || strftime(update_time, '%Y-%m-%d %H:%M:%S')
       || '","status":"IMPORTED RETRY"}}' AS body
FROM ({fx.SQL_STATE}) WHERE status <> 'IMPORTED SUCCESSFULLY'""",
)
def work_messages(spark, folder):
    failed = _state(spark, folder).where(F.col("status") != ledger.LOADED)
    return ledger.work_messages(failed, ledger.RETRY, F.col("update_time"))


@query("message_roundtrip", f"SELECT * FROM ({fx.SQL_MESSAGES})")
def message_roundtrip(spark, folder):
    return ledger.message_fields(fx.work_bodies(spark, folder))


@query(
    "messages_for_job",
    f"SELECT task_name, update_time, status FROM ({fx.SQL_MESSAGES}) WHERE job = 'job1' AND NOT is_end",
)
def messages_for_job(spark, folder):
    own = ledger.message_fields(fx.work_bodies(spark, folder)).where("job = 'job1' AND NOT is_end")
    return own.select("task_name", "update_time", "status")


@query("done_marker_counts", f"SELECT job, count(*) AS markers FROM ({fx.SQL_MESSAGES}) WHERE is_end GROUP BY job")
def done_marker_counts(spark, folder):
    return ledger.done_marker_counts(fx.work_bodies(spark, folder))


def _job_rows(spark, folder):
    events = fx.table(spark, folder, "events")
    state = fx.mapped("event_type", fx.STATE_OF)
    return events.select(
        F.col("user_id").alias("query_id"),
        F.concat(F.lit("j"), F.col("event_id").cast("string")).alias("job_id"),
        state.alias("state"),
        F.concat(
            F.lit('{"tbl":"events","partitions":["p'), F.date_format("ts", "yyyyMMdd"), F.lit('"]}')
        ).alias("task_info"),
        F.when(state == "CANCELLED", "cancelled by user").otherwise("").alias("error_msg"),
        "ts",
        F.col("event_id").alias("seq"),
    )


_SQL_JOB_STATES = f"""
SELECT user_id AS query_id, state, state IN ('PENDING', 'EXPORTING') AS running,
       'j' || event_id || '_' || user_id || '_events_p' || strftime(ts, '%Y%m%d') AS summary,
       CASE WHEN state = 'CANCELLED' THEN 'cancelled by user' ELSE '' END AS msg
FROM (SELECT *, {fx.sql_mapped('event_type', fx.STATE_OF)} AS state FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)"""


@query("job_state_rollup", _SQL_JOB_STATES)
def job_state_rollup(spark, folder):
    return ledger.job_states(_job_rows(spark, folder))


@query(
    "running_job_count",
    f"SELECT CAST(count_if(running) AS BIGINT) AS running_jobs, count(*) AS jobs FROM ({_SQL_JOB_STATES})",
)
def running_job_count(spark, folder):
    return ledger.running_jobs(ledger.job_states(_job_rows(spark, folder)))


@query(
    "failure_severity",
    """
SELECT event_id, event_type <> 'error' AS ok,
       CASE WHEN event_type <> 'error' THEN 'OK' WHEN user_id % 2 = 0 THEN 'EMPTY' ELSE 'ERROR' END AS severity
FROM events""",
)
def failure_severity(spark, folder):
    ok = F.col("event_type") != "error"
    text = F.when(F.col("user_id") % 2 == 0, f"load failed: {messages.NO_DATA_ENDING}").otherwise("time limit")
    return fx.table(spark, folder, "events").select(
        "event_id", ok.alias("ok"), messages.failure_severity(ok, text).alias("severity")
    )


@query(
    "job_summary",
    """
SELECT event_id, 'j' || user_id || '_q' || event_id || '_events_p' || strftime(ts, '%Y%m%d') AS job_summary,
       'events_' || event_id || ':' || event_type || '==>' || props AS load_summary
FROM events""",
)
def job_summary(spark, folder):
    ident = F.col("event_id").cast("string")
    return fx.table(spark, folder, "events").select(
        "event_id",
        messages.job_summary(
            F.concat(F.lit("j"), F.col("user_id").cast("string")),
            F.concat(F.lit("q"), ident),
            F.lit("events"),
            F.concat(F.lit("p"), F.date_format("ts", "yyyyMMdd")),
        ).alias("job_summary"),
        messages.load_summary(F.concat(F.lit("events_"), ident), F.col("event_type"), F.col("props")).alias(
            "load_summary"
        ),
    )


@query(
    "file_load_status",
    f"""
SELECT l.task_name, coalesce(n, 0) AS row_count, coalesce(n, 0) > 0 AS written, 'IMPORTED SUCCESSFULLY' AS status
FROM (SELECT DISTINCT task_name FROM ({fx.SQL_LEDGER})) l
LEFT JOIN (SELECT task_name, count(*) AS n FROM ({fx.SQL_LEDGER}) WHERE status = 'IMPORTED SUCCESSFULLY' GROUP BY 1) c
USING (task_name)""",
)
def file_load_status(spark, folder):
    """Purchases stand for the rows of a file; files without one are empty."""
    events = fx.ledger_events(spark, folder)
    rows = events.where(F.col("status") == ledger.LOADED).groupBy("task_name").agg(F.count("*").alias("row_count"))
    return load.file_load_status(events.select("task_name").distinct(), rows)
