import datetime as dt

from pyspark.sql import functions as F

from relocate.functions import messages, paths
from relocate.operators import ledger
from relocate.sources import listing

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "task_name string, status string, update_time timestamp_ntz, seq bigint, msg string"


def names(df):
    return sorted(row["task_name"] for row in df.collect())


def events(spark, rows):
    return spark.createDataFrame([(n, s, T0 + dt.timedelta(seconds=t), q, None) for n, s, t, q in rows], SCHEMA)


def test_latest_event_wins_and_sequence_breaks_ties(spark):
    rows = [
        ("a", ledger.LOADED, 1, 5),
        ("a", ledger.LOADING, 1, 4),
        ("b", ledger.LOADED, 1, 1),
        ("b", ledger.FAILED, 2, 0),
        ("c", None, 3, 1),
    ]
    state = {r["task_name"]: r["status"] for r in ledger.current_state(events(spark, rows)).collect()}
    assert state == {"a": ledger.LOADED, "b": ledger.FAILED, "c": None}


def test_one_file_with_most_of_the_events(spark):
    many = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("task_name"),
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("status"),
        F.lit(T0).cast("timestamp_ntz").alias("update_time"),
        F.col("id").alias("seq"),
        F.lit("").alias("msg"),
    )
    state = ledger.current_state(many)
    assert state.where("task_name = 'hot'").first()["status"] == "s19999"
    assert state.count() == 6668


def test_jobs_with_a_common_beginning_are_kept_apart(spark):
    rows = [(f"s3://b/stage/{job}/db/t/p1/f.parquet", ledger.FAILED, 1, 1) for job in ("job1", "job10", "a/job1")]
    state = ledger.current_state(events(spark, rows))
    only = ["s3://b/stage/job1/db/t/p1/f.parquet"]
    assert names(ledger.failed_files(state, "job1")) == only
    assert names(ledger.scan(state, "s3://b/stage/job1")) == only
    assert names(ledger.scan(state, "s3a://b/stage/job1/")) == only
    assert names(ledger.job_files(state, "job1")) == only


def test_status_filter_keeps_missing_status(spark):
    state = events(spark, [("s3://b/p/j/a", None, 1, 1), ("s3://b/p/j/b", ledger.LOADED, 1, 1)])
    assert names(ledger.scan(state, "s3://b/p/j", ledger.LOADED)) == ["s3://b/p/j/a"]


def test_folders_in_any_scheme(spark):
    df = spark.createDataFrame([("file:///tmp/x/j/f",), ("file:/tmp/x/j/f",), ("/tmp/x/j/f",), ("/tmp/x/jj/f",)], "p string")
    assert df.where(paths.below(F.col("p"), "/tmp/x/j")).count() == 3
    assert df.where(paths.below(F.col("p"), "file:/tmp/x/j/")).count() == 3


def test_short_paths_give_nulls(spark):
    df = spark.createDataFrame([("s3://b/p",), ("s3://b/p/j/d/t/pt=x/tmp/f.csv",)], "path string")
    short, full = df.select(*paths.task_fields("path")).collect()
    assert tuple(short) == ("b", "p", None, None, None, None, None)
    assert tuple(full) == ("b", "p", "j", "d", "t", "x", "tmp/f.csv")


def test_keys_are_decoded_before_they_are_tested(spark):
    keys = ["b/j/f%2Bx+y.parquet", "b/j/f%2Eparquet", "b/_temporary/f.csv", "b/%5Ftemporary/f.csv", "b/.f.csv", "b/f.json"]
    df = spark.createDataFrame([(key,) for key in keys], "raw_path string")
    assert names(listing.landed_files(df)) == ["s3://b/j/f+x y.parquet", "s3://b/j/f.parquet"]


def test_messages(spark):
    bodies = spark.createDataFrame(
        [
            ('{"task_name": "s3://b/p/j1/d/t/x/f.csv", "update_time": "t", "status": "IMPORTED RETRY"}',),
            ('{"task_name": "ALL TASK DONE", "update_time": "", "status": "j1"}',),
            ('{"task_name": "ALL TASK DONE", "update_time": "", "status": "j2"}',),
            ('{"task_name": "ALL TASK DONE", "update_time": "", "status": "j1"}',),
        ],
        "body string",
    )
    fields = ledger.message_fields(bodies)
    assert [(r["job"], r["is_end"]) for r in fields.where("job = 'j1'").collect()] == [("j1", False), ("j1", True), ("j1", True)]
    assert {tuple(r) for r in ledger.done_marker_counts(bodies).collect()} == {("j1", 2), ("j2", 1)}


def test_severity(spark):
    df = spark.createDataFrame(
        [(True, "x"), (False, "job: all partitions have no load data"), (False, "time limit"), (False, None)],
        "ok boolean, msg string",
    )
    got = [r[0] for r in df.select(messages.failure_severity(F.col("ok"), F.col("msg"))).collect()]
    assert got == ["OK", "EMPTY", "ERROR", "ERROR"]


def test_ledger_table(spark, tmp_path):
    record = ledger.Ledger(spark, f"{tmp_path}/ledger")
    assert record.current().count() == 0
    files = spark.createDataFrame([("s3://b/p/j/d/t/x/1",), ("s3://b/p/j/d/t/x/2",)], "task_name string")
    record.append(files, ledger.UPLOADED)
    record.append(files.limit(1), ledger.FAILED, "why")
    assert sorted((r["status"], r["msg"]) for r in record.current().collect()) == [
        (ledger.FAILED, "why"),
        (ledger.UPLOADED, ""),
    ]
    record.purge("s3://b/p/j")
    assert record.current().count() == 0
    record.append(files, ledger.UPLOADED)
    assert record.current().count() == 2
