"""Watches against a plain version: any split, odd rows, replays and restarts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from relocate import TableSpec
from relocate.operators import ledger, load, loads
from relocate.plans import job as plan
from relocate.streaming import watch

DAY = dt.datetime(2024, 3, 10)
SAID = "task_name string, announced_at timestamp_ntz"
SEEN = "task_name string, landed_at timestamp_ntz"


def at(minutes):
    return DAY + dt.timedelta(minutes=minutes)


def episodes(signs, wait):
    """Signs ``(file, minute, …)`` of a file, apart where more than ``wait`` minutes pass."""
    found = {}
    for sign in sorted(signs, key=lambda s: s[:2]):
        groups = found.setdefault(sign[0], [])
        if groups and sign[1] - groups[-1][-1][1] <= wait:
            groups[-1].append(sign)
        else:
            groups.append([sign])
    return [group for groups in found.values() for group in groups]


def expected(signs, wait, mark=None):
    out = []
    for group in episodes(signs, wait):
        if mark is not None and group[-1][1] + wait > mark:
            continue
        said, seen = ([s[1] for s in group if s[2] == kind] for kind in ("said", "seen"))
        outcome = watch.MISSING if not seen else watch.UNANNOUNCED if not said else watch.LANDED
        first = [at(min(times)) if times else None for times in (said, seen)]
        out.append((group[0][0], *first, len(said), len(seen), outcome))
    return sorted(out, key=repr)


def frames(spark, signs):
    said = spark.createDataFrame([(s[0], at(s[1])) for s in signs if s[2] == "said"], SAID)
    return said, spark.createDataFrame([(s[0], at(s[1])) for s in signs if s[2] == "seen"], SEEN)


def found(df):
    return sorted([tuple(row) for row in df.collect()], key=repr)


@pytest.fixture
def signs():
    draw = random.Random(5)
    return [(f"s3://b/f{draw.randrange(12)}", draw.randrange(0, 1500, 10), draw.choice(["said", "seen"])) for _ in range(150)]


def test_arrivals_of_tables_against_a_plain_version(spark, signs):
    # times in steps of ten minutes: gaps of exactly the wait occur
    assert any(b[1] - a[1] == 60 for g in episodes(signs, 60) for a, b in zip(g, g[1:]))
    assert found(watch.arrivals(*frames(spark, signs), "60 minutes", "1 minute")) == expected(signs, 60)


@pytest.mark.parametrize("cuts", [[], [700], [200, 210, 1100]])
def test_any_split_of_the_signs_gives_the_same_report(spark, signs, tmp_path, cuts):
    folders = [f"{tmp_path}/{name}" for name in ("said", "seen", "report", "checkpoint")]
    for low, high in zip([0, *cuts], [*cuts, 9999]):
        part = [s for s in signs if low <= s[1] < high]
        for df, folder in zip(frames(spark, part), folders):
            df.write.mode("append").parquet(folder)
        said, seen = (spark.readStream.schema(s).parquet(f) for s, f in zip((SAID, SEEN), folders))
        report = watch.arrivals(said, seen, "60 minutes", "20 minutes")
        for _ in range(2):
            watch.record_report(report, folders[2], folders[3]).awaitTermination()
    mark = min(max(s[1] for s in signs if s[2] == kind) for kind in ("said", "seen")) - 20
    assert found(spark.read.schema(report.schema).parquet(folders[2])) == expected(signs, 60, mark)


def test_a_listing_that_lags_reports_nothing_as_missing(spark, tmp_path):
    folders = [f"{tmp_path}/{name}" for name in ("said", "seen", "report", "checkpoint")]
    rounds = [
        [("f1", 0, "said"), ("f2", 600, "said"), ("f0", 0, "seen")],
        [("f1", 30, "seen"), ("f3", 600, "seen")],
        [("f4", 700, "said"), ("f3", 610, "seen")],
    ]
    outcomes = []
    for part in rounds:
        for df, folder in zip(frames(spark, part), folders):
            df.write.mode("append").parquet(folder)
        said, seen = (spark.readStream.schema(s).parquet(f) for s, f in zip((SAID, SEEN), folders))
        report = watch.arrivals(said, seen, "60 minutes", "1 minute")
        watch.record_report(report, folders[2], folders[3]).awaitTermination()
        rows = spark.read.schema(report.schema).parquet(folders[2]).collect()
        outcomes.append({row["task_name"]: row["outcome"] for row in rows})
    # after a restart both streams must have moved
    assert outcomes == [{}, {}, {"f0": watch.UNANNOUNCED, "f1": watch.LANDED}]


def test_odd_signs(spark):
    said = spark.createDataFrame([(None, at(0)), ("f", None), ("s3://b/x", at(0)), ("s3a://b/x", at(1))], SAID)
    seen = spark.createDataFrame([("s3a://b/x", at(2)), ("s3a://b/x", at(2))], SEEN)
    assert found(watch.arrivals(said, seen, "1 hour", "1 minute")) == [("s3://b/x", at(0), at(2), 2, 2, watch.LANDED)]
    assert found(watch.arrivals(said.limit(0), seen.limit(0), "1 hour", "1 minute")) == []


def test_session_zone_does_not_matter(spark):
    # 02:00 to 03:00 of that day does not exist in New York
    signs = [("f", 115, "said"), ("f", 125, "seen"), ("f", 185, "seen"), ("g", 130, "said")]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = found(watch.arrivals(*frames(spark, signs), "30 minutes", "1 minute"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == expected(signs, 30)


def event_rows(spark, rows):
    full = [(name, status, at(minute), seq, "", label) for name, status, minute, seq, label in rows]
    return spark.createDataFrame(full, ledger.EVENT_SCHEMA)


def test_stuck_loads(spark):
    rows = [
        ("slow", ledger.LOADING, 0, 1, "a"),
        ("slow", ledger.LOADED, 40, 2, "a"),
        ("tie", ledger.LOADING, 0, 3, "a"),
        ("tie", ledger.LOADED, 0, 4, "a"),
        ("stuck", ledger.LOADED, 0, 5, "a"),
        ("stuck", ledger.LOADING, 10, 6, "b"),
        ("twice", ledger.LOADING, 0, 7, "a"),
        ("twice", ledger.LOADING, 61, 8, "b"),
        ("waits", ledger.UPLOADED, 0, 9, None),
        (None, ledger.LOADING, 0, 10, "a"),
    ]
    got = watch.stuck_loads(event_rows(spark, rows), "1 hour", "1 minute")
    assert got.columns == event_rows(spark, rows).columns
    assert sorted((r["task_name"], r["update_time"], r["seq"], r["load_id"]) for r in got.collect()) == [
        ("stuck", at(70), 6, "b"),
        ("twice", at(60), 7, "a"),
        ("twice", at(121), 8, "b"),
    ]


def test_replayed_batch_raises_once(spark, tmp_path):
    source, point = f"{tmp_path}/events", f"{tmp_path}/checkpoint"
    record = ledger.Ledger(spark, f"{tmp_path}/raised")
    event_rows(spark, [("f", ledger.LOADING, 0, 1, "a"), ("g", ledger.LOADED, 500, 2, "a")]).write.parquet(source)
    stream = spark.readStream.schema(ledger.EVENT_SCHEMA).parquet(source)

    def run():
        watch.raise_retries(watch.stuck_loads(stream, "1 hour", "1 minute"), record, point).awaitTermination()

    run()
    assert [r["task_name"] for r in record.events().collect()] == ["f"]
    # the last batch again: its commit is taken away
    commits = sorted(int(p.name) for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit())
    for name in (f"{commits[-1]}", f".{commits[-1]}.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    run()
    assert [r["task_name"] for r in record.events().collect()] == ["f"]


@pytest.mark.parametrize("published", [False, True])
def test_import_after_a_raised_retry_finishes_the_stuck_load(spark, tmp_path, monkeypatch, published):
    spec = TableSpec("t", partition="p")
    rows = spark.range(300).select("id", F.concat(F.lit("p"), (F.col("id") % 5).cast("string")).alias("p"))
    job = plan.Job("job1", "db", f"{tmp_path}/stage", f"{tmp_path}/target", f"{tmp_path}/ledger", max_rows_per_file=40)
    plan.export_table(rows, spec, job)
    plain = loads.LoadLog.publish

    def cut(self, *args, **named):
        if published:
            plain(self, *args, **named)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(loads.LoadLog, "publish", cut)
        with pytest.raises(RuntimeError, match="driver lost"):
            plan.import_table(spark, rows.schema, spec, job)
    record = job.ledger(spark)
    stuck = record.hold(watch.stuck_loads(record.events(), "1 millisecond", "1 minute"))
    assert stuck.count() > 0
    stuck.write.mode("append").parquet(record.folder)
    assert {r["status"] for r in record.current().collect()} == {ledger.RETRY}
    plan.import_table(spark, rows.schema, spec, job)
    shown = plan.loaded_table(spark, rows.schema, spec, job)
    assert sorted(r["id"] for r in shown.collect()) == list(range(300))
    assert load.read_loaded(spark, job.target("t"), rows.schema).count() == 300
