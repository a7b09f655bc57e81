import pytest
from pyspark.sql import functions as F

from relocate import TableSpec
from relocate.operators import ledger, load, stage
from relocate.sources import staged
from relocate.streaming import increments, load as stream

SPEC = TableSpec("t", partition="p")


@pytest.fixture
def rows(spark):
    return spark.range(200).select("id", F.concat(F.lit("p"), (F.col("id") % 8).cast("string")).alias("p"))


def ids(df):
    return sorted(row["id"] for row in df.select("id").collect())


def stage_rows(rows, folder):
    stage.stage_rows(stage.staged_rows(rows, SPEC), folder, 10)


def test_arrivals_between_runs_are_loaded_once(spark, rows, tmp_path):
    source, target, point = (f"{tmp_path}/{name}" for name in ("stage", "target", "checkpoint"))
    record = ledger.Ledger(spark, f"{tmp_path}/ledger")
    for part in ("id % 8 < 3", "id % 8 >= 3"):
        stage_rows(rows.where(part), source)
        for _ in range(2):
            stream.stream_load(
                spark, source, rows.schema, target, point, record, max_files_per_trigger=4
            ).awaitTermination()
    assert ids(load.read_loaded(spark, target, rows.schema)) == list(range(200))
    state = record.current()
    assert {r["status"] for r in state.collect()} == {ledger.LOADED}
    assert state.agg(F.sum(F.col("msg").cast("int"))).first()[0] == 200


def test_failed_batch_is_replayed_without_doubling(spark, rows, tmp_path, monkeypatch):
    source, target, point = (f"{tmp_path}/{name}" for name in ("stage", "target", "checkpoint"))
    stage_rows(rows, source)
    plain, calls = stream.append_once, []

    def write_then_fail(df, folder, load_id):
        plain(df, folder, load_id)
        calls.append(load_id)
        if len(calls) == 2:
            raise RuntimeError("driver lost after the write")

    monkeypatch.setattr(stream, "append_once", write_then_fail)
    query = stream.stream_load(spark, source, rows.schema, target, point, max_files_per_trigger=6)
    with pytest.raises(Exception, match="driver lost"):
        query.awaitTermination()
    stream.stream_load(spark, source, rows.schema, target, point, max_files_per_trigger=6).awaitTermination()
    assert calls[1] == calls[2]
    assert ids(load.read_loaded(spark, target, rows.schema)) == list(range(200))


def test_two_streams_share_a_target(spark, rows, tmp_path):
    target = f"{tmp_path}/target"
    for name, part in (("a", "id < 100"), ("b", "id >= 100")):
        stage_rows(rows.where(part), f"{tmp_path}/{name}")
        stream.stream_load(
            spark, f"{tmp_path}/{name}", rows.schema, target, f"{tmp_path}/checkpoint-{name}", max_bytes_per_trigger=1000
        ).awaitTermination()
    assert ids(load.read_loaded(spark, target, rows.schema)) == list(range(200))


def test_text_stream(spark, rows, tmp_path):
    text = staged.text_format()
    stage.stage_rows(stage.staged_rows(rows, SPEC), f"{tmp_path}/stage", 10, stage_format=text)
    stream.stream_load(
        spark, f"{tmp_path}/stage", rows.schema, f"{tmp_path}/t", f"{tmp_path}/c", max_files_per_trigger=9, stage_format=text
    ).awaitTermination()
    assert ids(load.read_loaded(spark, f"{tmp_path}/t", rows.schema)) == list(range(200))


def test_increments(spark):
    table = spark.range(10).select(F.col("id").alias("k"))
    assert increments.high_water(table, "k") == "9"
    assert increments.high_water(table.limit(0), "k") is None
    assert increments.extract_increment(table, "k", None, None).count() == 0
    assert increments.extract_increment(table, "k", None, "4").count() == 5
    assert increments.extract_increment(table, "k", "4", "9").count() == 5
    assert increments.extract_increment(table, "k", "9", "9").count() == 0


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "double", "decimal(20,6)", "bigint", "string"])
def test_marks_of_every_type_split_a_table_exactly(spark, tmp_path, kind):
    """Times around the end of daylight saving, in a zone that has it."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        micros = F.lit(1730610000_000001) + F.col("id") * 601_000_000
        seconds = {
            "timestamp": F.timestamp_micros(micros),
            "timestamp_ntz": F.convert_timezone(F.lit("UTC"), F.lit("UTC"), F.timestamp_micros(micros).cast("timestamp_ntz")),
            "date": F.date_add(F.lit("2024-11-01").cast("date"), F.col("id").cast("int")),
            "string": F.lpad(F.col("id").cast("string"), 4, "0"),
        }
        table = spark.range(40).select("id", seconds.get(kind, (F.col("id") / 7).cast(kind)).alias("k"))
        distinct = table.select("k").distinct().count()
        marks = increments.HighWater(spark, f"{tmp_path}/marks")
        low = increments.high_water(table.where("id < 17"), "k")
        marks.advance("t", low)
        assert marks.last(table, "k", "t") == low
        high = increments.high_water(table, "k")
        before = increments.extract_increment(table, "k", None, low)
        after = increments.extract_increment(table, "k", low, high)
        assert before.count() + after.count() == 40
        assert before.agg(F.max("k")).collect() == table.where("id < 17").agg(F.max("k")).collect()
        assert before.select("k").distinct().count() + after.select("k").distinct().count() == distinct
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_marks_are_compared_as_keys_not_as_text(spark, tmp_path):
    marks = increments.HighWater(spark, f"{tmp_path}/marks")
    table = spark.range(1)
    assert marks.last(table, "id", "t") is None
    for mark in ("9", "10"):
        marks.advance("t", mark)
    marks.advance("u", "99")
    assert marks.last(table, "id", "t") == "10"
