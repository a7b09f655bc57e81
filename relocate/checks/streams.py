"""Streaming loads, the streaming ledger and increments by key. Each stream drains and stops."""

from pyspark.sql import functions as F

from relocate.checks import fixtures as fx
from relocate.checks import query
from relocate.functions.paths import PARTITION_FIELD
from relocate.operators import ledger, load, stage
from relocate.plans import job as plan
from relocate.session import work_folder
from relocate.streaming import increments
from relocate.streaming.events import stream_ledger
from relocate.streaming.load import stream_load


def _staged_events(spark, folder):
    events = fx.table(spark, folder, "events")
    out = work_folder(spark, "stage")
    stage.stage_rows(stage.staged_rows(events, fx.EVENTS), out)
    return events, out


@query("stream_load", "SELECT * FROM events")
def stream_load_query(spark, folder):
    """Staged days loaded in several micro-batches."""
    events, staged_folder = _staged_events(spark, folder)
    target = work_folder(spark, "target")
    record = ledger.Ledger(spark, work_folder(spark, "ledger"))
    stream_load(
        spark,
        staged_folder,
        events.schema,
        target,
        work_folder(spark, "checkpoint"),
        record,
        max_files_per_trigger=16,
    ).awaitTermination()
    return load.read_loaded(spark, target, events.schema)


@query(
    "stream_rerun_noop",
    "SELECT strftime(ts, 'p%Y%m%d') AS name, count(*) AS row_count FROM events GROUP BY 1",
)
def stream_rerun_noop(spark, folder):
    """A second run over the same checkpoint adds nothing."""
    events, staged_folder = _staged_events(spark, folder)
    target, checkpoint = work_folder(spark, "target"), work_folder(spark, "checkpoint")
    for _ in range(2):
        stream_load(spark, staged_folder, events.schema, target, checkpoint).awaitTermination()
    loaded = load.read_loaded(spark, target, events.schema)
    return loaded.groupBy(fx.EVENTS.partition_column().alias("name")).agg(F.count("*").alias("row_count"))


@query("stream_ledger", fx.SQL_STATE)
def stream_ledger_query(spark, folder):
    """Status events that arrive as files, added to a ledger and folded."""
    events = fx.ledger_events(spark, folder)
    out = work_folder(spark, "messages")
    stage.gathered(events.withColumn(PARTITION_FIELD, F.to_date("update_time")), PARTITION_FIELD).drop(
        PARTITION_FIELD
    ).write.parquet(out)
    record = ledger.Ledger(spark, work_folder(spark, "ledger"))
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 4).parquet(out)
    stream_ledger(arriving, record, work_folder(spark, "checkpoint")).awaitTermination()
    return record.current().select("task_name", "status", "update_time")


@query(
    "incremental_extract",
    f"SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{fx.SNAPSHOT_END}')",
)
def incremental_extract(spark, folder):
    events = fx.table(spark, folder, "events")
    low = increments.high_water(fx.snapshot(spark, folder), "ts")
    return increments.extract_increment(events, "ts", low, increments.high_water(events, "ts"))


@query("sync_increments", "SELECT * FROM events")
def sync_increments(spark, folder):
    """The snapshot synced first, then what came after its high-water mark, then nothing."""
    events = fx.table(spark, folder, "events")
    job = plan.Job(
        "sync1", "db", work_folder(spark, "stage"), work_folder(spark, "target"), work_folder(spark, "ledger")
    )
    marks = increments.HighWater(spark, work_folder(spark, "marks"))
    for rows in (fx.snapshot(spark, folder), events, events):
        plan.sync_table(rows, fx.EVENTS, "ts", job, marks)
    return plan.loaded_table(spark, events.schema, fx.EVENTS, job)


@query(
    "sync_ties_and_nulls",
    "SELECT event_id, value, CASE WHEN event_id % 101 <> 0 THEN date_trunc('hour', ts) END AS ts FROM events",
)
def sync_ties_and_nulls(spark, folder):
    """Hourly keys and missing ones; half of the last hour, and of the rows without a key, comes a round later."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    events = fx.table(spark, folder, "events").select("event_id", "value", F.when(F.col("event_id") % 101 != 0, hour).alias("ts"))
    cut = F.lit(fx.SNAPSHOT_END + " 10:00:00").cast("timestamp_ntz")
    even = F.col("event_id") % 2 == 0
    rounds = [
        events.where((F.col("ts") < cut) | (((F.col("ts") == cut) | F.col("ts").isNull()) & even)),
        events.where((F.col("ts") <= cut) | F.col("ts").isNull()),
        events,
        events,
    ]
    job = plan.Job("ties", "db", work_folder(spark, "stage"), work_folder(spark, "target"), work_folder(spark, "ledger"))
    marks = increments.HighWater(spark, work_folder(spark, "marks"))
    for rows in rounds:
        plan.sync_table(rows, fx.EVENTS, "ts", job, marks)
    return plan.loaded_table(spark, events.schema, fx.EVENTS, job)
