"""Watches over streams of signs, run in rounds that restart from their checkpoint. Each stream drains and stops."""

from pyspark.sql import functions as F

from relocate.checks import fixtures as fx
from relocate.checks import query
from relocate.operators import ledger
from relocate.session import work_folder
from relocate.streaming import watch

WAIT, DELAY = "6 hours", "1 hour"
CUTS = ("2024-01-10", "2024-01-20")
ANNOUNCING = ("view", "click", "error")

# Rows of ``{signs}`` (task_name, ts, event_id, …) by episode, and the watermark after the last of them.
_SQL_EPISODES = f"""
SELECT *, sum(fresh) OVER (PARTITION BY task_name ORDER BY ts, event_id) AS episode
FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY task_name ORDER BY ts, event_id) <= INTERVAL {WAIT}
                     THEN 0 ELSE 1 END AS fresh FROM (SELECT *, {fx.SQL_TASK} AS task_name FROM events))"""
_SQL_MARK = f"date_trunc('milliseconds', {{last}}) - INTERVAL {DELAY}"


def _rounds(events):
    """The events by time, as three rounds."""
    first, second = (F.lit(cut).cast("timestamp_ntz") for cut in CUTS)
    ts = F.col("ts")
    return [events.where(ts < first), events.where((ts >= first) & (ts < second)), events.where(ts >= second)]


def _arriving(spark, rows, folder):
    return spark.readStream.schema(rows.schema).parquet(folder)


@query(
    "announced_against_landed",
    f"""
WITH signs AS (SELECT *, event_type IN {ANNOUNCING} AS announced FROM ({_SQL_EPISODES})),
mark AS (SELECT {_SQL_MARK.format(last="least(max(ts) FILTER (WHERE announced), max(ts) FILTER (WHERE NOT announced))")} AS m
         FROM signs)
SELECT task_name, min(ts) FILTER (WHERE announced) AS announced_at, min(ts) FILTER (WHERE NOT announced) AS landed_at,
       count(*) FILTER (WHERE announced) AS announcements, count(*) FILTER (WHERE NOT announced) AS landings,
       CASE WHEN bool_and(announced) THEN 'never landed' WHEN NOT bool_or(announced) THEN 'not announced'
            ELSE 'landed' END AS outcome
FROM signs GROUP BY task_name, episode HAVING max(ts) + INTERVAL {WAIT} <= (SELECT m FROM mark)""",
)
def announced_against_landed(spark, folder):
    """Views, clicks and errors announce a file, other events say that it is there."""
    events = fx.table(spark, folder, "events")
    is_said = F.col("event_type").isin(*ANNOUNCING)
    said_at, seen_at, out, point = (work_folder(spark, name) for name in ("said", "seen", "report", "checkpoint"))
    for rows in _rounds(events.withColumn("task_name", fx.task_names(events))):
        said = rows.where(is_said).select("task_name", F.col("ts").alias("announced_at"))
        seen = rows.where(~is_said).select("task_name", F.col("ts").alias("landed_at"))
        said.write.mode("append").parquet(said_at)
        seen.write.mode("append").parquet(seen_at)
        report = watch.arrivals(_arriving(spark, said, said_at), _arriving(spark, seen, seen_at), WAIT, DELAY)
        watch.record_report(report, out, point).awaitTermination()
    return spark.read.schema(report.schema).parquet(out)


@query(
    "stuck_load_retries",
    f"""
SELECT task_name, 'IMPORTED RETRY' AS status, ts + INTERVAL {WAIT} AS update_time, event_id AS seq
FROM (SELECT * FROM ({_SQL_EPISODES})
      QUALIFY row_number() OVER (PARTITION BY task_name, episode ORDER BY ts DESC, event_id DESC) = 1)
WHERE event_type = 'view'
  AND ts + INTERVAL {WAIT} <= (SELECT {_SQL_MARK.format(last="max(ts)")} FROM events)""",
)
def stuck_load_retries(spark, folder):
    """Loads without a sign for six hours; the last round is run twice."""
    events, out = fx.ledger_events(spark, folder), work_folder(spark, "messages")
    raised = ledger.Ledger(spark, work_folder(spark, "ledger"))
    point = work_folder(spark, "checkpoint")
    for rows in [*_rounds(events.withColumn("ts", F.col("update_time"))), None]:
        if rows is not None:
            rows.drop("ts").write.mode("append").parquet(out)
        stuck = watch.stuck_loads(_arriving(spark, events, out), WAIT, DELAY)
        watch.raise_retries(stuck, raised, point).awaitTermination()
    return raised.events().select("task_name", "status", "update_time", "seq")
