"""Loads: each row once, whatever is repeated, cut short or late."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from relocate import Selector, TableSpec
from relocate.operators import ledger, load, stage
from relocate.plans import job as plan
from relocate.sources import listing, staged
from relocate.streaming import increments

SPEC = TableSpec("t", partition="p")
KEYED = replace(SPEC, unique_key=("id",))


@pytest.fixture
def job(tmp_path):
    return plan.Job("job1", "db", f"{tmp_path}/stage", f"{tmp_path}/target", f"{tmp_path}/ledger", max_rows_per_file=40)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(300).select("id", F.concat(F.lit("p"), (F.col("id") % 5).cast("string")).alias("p"))


def ids(df):
    return sorted(row["id"] for row in df.select("id").collect())


def loaded(spark, rows, job, spec=SPEC):
    return ids(plan.loaded_table(spark, rows.schema, spec, job))


def states(spark, job):
    found = job.ledger(spark).current().groupBy("status").count().collect()
    return {row["status"]: row["count"] for row in found}


def test_export_then_import_twice(spark, rows, job):
    report = plan.export_table(rows, SPEC, job)
    assert {(r["partition"], r["row_count"]) for r in report.collect()} == {(f"p{i}", 60) for i in range(5)}
    assert states(spark, job) == {ledger.UPLOADED: 10}
    first = plan.import_table(spark, rows.schema, SPEC, job)
    assert first.agg(F.sum("row_count")).first()[0] == 300
    assert plan.import_table(spark, rows.schema, SPEC, job).count() == 0
    assert loaded(spark, rows, job) == list(range(300))
    assert states(spark, job) == {ledger.LOADED: 10}


@pytest.mark.parametrize("cut", ["before the record", "half written", "half written and not recorded"])
def test_load_cut_short(spark, rows, job, monkeypatch, cut):
    plan.export_table(rows.where("id < 100"), SPEC, job)
    record, write = ledger.Ledger.append, load.append_once

    def lost(self, files, status, *rest, **named):
        if status in (ledger.LOADED, ledger.FAILED):
            raise RuntimeError("driver lost")
        record(self, files, status, *rest, **named)

    def half(df, folder, load_id):
        write(df.where("id < 50"), folder, load_id)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        if cut != "half written":
            broken.setattr(ledger.Ledger, "append", lost)
        if cut != "before the record":
            broken.setattr(load, "append_once", half)
        with pytest.raises(RuntimeError):
            plan.import_table(spark, rows.schema, SPEC, job)
    # a load is seen whole or not at all
    assert loaded(spark, rows, job) == (list(range(100)) if cut == "before the record" else [])
    # More files arrive before the next run, so that it is not the same load again.
    extra = stage.staged_rows(rows.where("id >= 100").withColumn("p", F.lit("late")), SPEC)
    stage.stage_rows(extra, job.stage("t"))
    status = plan.import_table(spark, rows.schema, SPEC, job)
    assert status.agg(F.sum("row_count")).first()[0] == 300
    assert loaded(spark, rows, job) == list(range(300))
    assert set(states(spark, job)) == {ledger.LOADED}


def test_failed_load_is_recorded_and_retried(spark, rows, job, monkeypatch):
    plan.export_table(rows, SPEC, job)
    plain = load.append_once

    def fail(*_):
        raise OSError("disk full")

    monkeypatch.setattr(load, "append_once", fail)
    with pytest.raises(OSError):
        plan.import_table(spark, rows.schema, SPEC, job)
    monkeypatch.setattr(load, "append_once", plain)
    assert states(spark, job) == {ledger.FAILED: 10}
    assert job.ledger(spark).current().first()["msg"] == "disk full"
    plan.retry(spark, rows.schema, SPEC, job)
    assert loaded(spark, rows, job) == list(range(300))


def test_file_that_lands_after_the_listing_waits(spark, rows, job):
    folder = job.stage("t")
    stage.stage_rows(stage.staged_rows(rows.where("id < 100"), SPEC), folder)
    landed = listing.list_files(spark, folder)
    stage.stage_rows(stage.staged_rows(rows.where("id >= 100").withColumn("p", F.lit("late")), SPEC), folder)
    read = staged.read_staged(spark, folder, rows.schema)
    load.load_files(spark, landed, read, job.target("t"), job.ledger(spark))
    assert loaded(spark, rows, job) == list(range(100))
    plan.import_table(spark, rows.schema, SPEC, job)
    assert loaded(spark, rows, job) == list(range(300))


def test_empty_file_is_a_success_without_rows(spark, rows, job):
    plan.export_table(rows.where("id < 10"), SPEC, job)
    rows.limit(0).drop("p").coalesce(1).write.parquet(job.stage("t") + "/pt=p9")
    status = {r["task_name"]: r for r in plan.import_table(spark, rows.schema, SPEC, job).collect()}
    empty = [r for name, r in status.items() if "pt=p9" in name]
    assert [(r["row_count"], r["written"], r["status"]) for r in empty] == [(0, False, ledger.LOADED)]
    assert all(r["written"] for name, r in status.items() if "pt=p9" not in name)
    assert loaded(spark, rows, job) == list(range(10))


@pytest.mark.parametrize("literals, broadcast", [(1000, 10), (2, 1000), (2, 0)])
def test_wanted_files_by_literal_broadcast_and_shuffle(spark, rows, job, monkeypatch, literals, broadcast):
    monkeypatch.setattr(load, "LITERAL_LIMIT", literals)
    monkeypatch.setattr(load, "BROADCAST_FILES", broadcast)
    folder = job.stage("t")
    stage.stage_rows(stage.staged_rows(rows, SPEC), folder, 20)
    read = staged.read_staged(spark, folder, rows.schema)
    counts = load.file_counts(read).cache()
    for wanted in ("pt=p0", "pt=p[0-3]", "pt=", "pt=none"):
        pending = counts.where(F.col("task_name").rlike(wanted)).select("task_name")
        marked = load.wanted_files(counts, pending)
        _, taken, left_out = load.load_plan(marked)
        got = load.rows_of_files(read, marked, taken, left_out)
        expected = ids(read.where(F.col("_metadata.file_path").rlike(wanted)))
        assert ids(got) == expected
    counts.unpersist()


def test_files_replaced_before_their_load_leave_the_ledger(spark, rows, job):
    plan.export_table(rows, SPEC, job)
    before = {r["task_name"] for r in job.ledger(spark).current().collect()}
    plan.export_table(rows.where("p = 'p1'"), SPEC, job)
    after = {r["task_name"] for r in job.ledger(spark).current().collect()}
    assert {name for name in before - after} == {name for name in before if "/pt=p1/" in name}
    assert len(after) == 10
    plan.import_table(spark, rows.schema, SPEC, job)
    assert loaded(spark, rows, job) == list(range(300))


def test_text_with_line_breaks_is_counted_by_rows(spark, job):
    words = spark.range(60).select(
        "id",
        F.expr("CASE id % 3 WHEN 0 THEN concat('a\n', id, '\n\nb \"x\"') WHEN 1 THEN '' END").alias("text"),
        F.lit("a").alias("p"),
    )
    texts = replace(job, stage_format=staged.text_format(), max_rows_per_file=7)
    plan.export_table(words, SPEC, texts)
    status = plan.import_table(spark, words.schema, SPEC, texts)
    assert status.agg(F.sum("row_count")).first()[0] == 60
    back = plan.loaded_table(spark, words.schema, SPEC, texts)
    assert back.exceptAll(words).isEmpty() and words.exceptAll(back).isEmpty()


def test_label_depends_on_the_files_alone(spark):
    names = spark.createDataFrame([(f"f{i}", True) for i in range(9)], "task_name string, wanted boolean")
    label, taken, left_out = load.load_plan(names)
    assert (taken, left_out) == (9, 0)
    assert load.load_plan(names.orderBy(F.rand()))[0] == label
    more = names.union(spark.createDataFrame([("g", False)], names.schema))
    assert load.load_plan(more) == (label, 9, 1)
    assert load.load_plan(names.where("task_name <> 'f3'"))[0] != label


@pytest.mark.parametrize("spec", [SPEC, KEYED])
def test_retry_of_loaded_files_shows_each_row_once(spark, rows, job, spec):
    plan.export_table(rows, spec, job)
    plan.import_table(spark, rows.schema, spec, job)
    assert plan.retry(spark, rows.schema, spec, job, partition="p1").count() == 2
    assert loaded(spark, rows, job, spec) == list(range(300))
    assert plan.retry(spark, rows.schema, spec, job, force=True).count() == 10
    assert loaded(spark, rows, job, spec) == list(range(300))


def test_later_load_replaces_earlier_row(spark, job):
    first = spark.createDataFrame([(1, "old", "a"), (2, "kept", "a")], "id int, v string, p string")
    plan.export_table(first, KEYED, job)
    plan.import_table(spark, first.schema, KEYED, job)
    second = spark.createDataFrame([(1, "new", "b")], first.schema)
    plan.export_table(second, KEYED, job)
    plan.import_table(spark, first.schema, KEYED, job)
    got = plan.loaded_table(spark, first.schema, KEYED, job)
    assert {(r["id"], r["v"]) for r in got.collect()} == {(1, "new"), (2, "kept")}


def test_selected_partitions_of_the_target_are_pruned(spark, rows, job):
    plan.export_table(rows, SPEC, job)
    plan.import_table(spark, rows.schema, SPEC, job)
    part = plan.loaded_table(spark, rows.schema, replace(SPEC, selector=Selector.parse("EACH(p1)")), job)
    assert ids(part) == list(range(1, 300, 5))
    text = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pt" in text


def test_rows_without_partition_are_loaded_but_not_selected(spark, job):
    rows = spark.createDataFrame([(1, None), (2, "p1"), (3, "p2")], "id bigint, p string")
    plan.export_table(rows, SPEC, job)
    plan.import_table(spark, rows.schema, SPEC, job)
    assert loaded(spark, rows, job) == [1, 2, 3]
    some = replace(SPEC, selector=Selector.parse("STARTWITH(p1)"))
    assert loaded(spark, rows, job, some) == [2, 3]
    report = plan.validate([(some, rows, plan.loaded_table(spark, rows.schema, some, job))])
    assert {r["status"] for r in report.collect()} == {"MATCH"}


def test_export_of_partition_folders_has_no_shuffle(spark, rows, job, tmp_path):
    rows.write.partitionBy("p").parquet(f"{tmp_path}/source")
    source = spark.read.schema(rows.schema).parquet(f"{tmp_path}/source")
    spec, still = replace(SPEC, selector=Selector.parse("RANGE(p1,p3)")), replace(job, gather=False)
    text = stage.staged_rows(source, spec)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "PartitionFilters: [isnotnull(p" in text
    plan.export_table(source, spec, still)
    plan.import_table(spark, rows.schema, spec, still)
    assert loaded(spark, rows, still) == sorted(ids(rows.where("p IN ('p1', 'p2')")))


def test_purged_job_is_gone_and_its_namesake_stays(spark, rows, job):
    other = replace(job, name="job10")
    for one in (job, other):
        plan.export_table(rows, SPEC, one)
    plan.purge(spark, job)
    left = {r["task_name"] for r in job.ledger(spark).current().collect()}
    assert len(left) == 10 and all("/job10/" in name for name in left)


def test_sync_takes_each_row_once(spark, job, tmp_path, monkeypatch):
    marks = increments.HighWater(spark, f"{tmp_path}/marks")
    table = spark.range(100).select("id", F.lit("a").alias("p"))
    plan.sync_table(table.where("id < 30"), SPEC, "id", job, marks)
    # The run is cut short before the mark moves; the table has grown when it is repeated.
    with monkeypatch.context() as broken:
        broken.setattr(increments.HighWater, "advance", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            plan.sync_table(table.where("id < 60"), SPEC, "id", job, marks)
    report = plan.sync_table(table, SPEC, "id", job, marks)
    assert [tuple(r) for r in report.collect()] == [("a", 70)]
    assert plan.sync_table(table, SPEC, "id", job, marks).count() == 0
    assert loaded(spark, table, job) == list(range(100))


def test_late_rows_of_a_sync_that_was_cut_short_stay(spark, job, tmp_path, monkeypatch):
    marks = increments.HighWater(spark, f"{tmp_path}/marks")
    table = spark.range(100).select("id", F.when(F.col("id") % 10 > 0, F.col("id") % 3).alias("k"), F.lit("a").alias("p"))
    first, late = (F.col("k") < 1) | (F.col("k") == 1) & (F.col("id") < 50), (F.col("k") <= 1) | F.col("k").isNull()
    plan.sync_table(table.where(first), SPEC, "k", job, marks)
    with monkeypatch.context() as broken:
        broken.setattr(increments.HighWater, "advance", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            plan.sync_table(table.where(late), SPEC, "k", job, marks)
    plan.sync_table(table, SPEC, "k", job, marks)
    assert plan.sync_table(table, SPEC, "k", job, marks).count() == 0
    assert loaded(spark, table, job) == list(range(100))


def brute_latest(rows):
    best = {}
    for key, version, value in rows:
        if key not in best or version > best[key][0]:
            best[key] = (version, value)
    return {(key, *rest) for key, rest in best.items()}


def test_upsert_against_brute_force(spark):
    # Half of the rows share one key, and some keys are NULL.
    made = [(None if i % 11 == 0 else (7 if i % 2 else i % 40), i * 7919 % 5003, i) for i in range(4000)]
    half = len(made) // 2
    schema = "k int, version int, value int"
    base, increment = spark.createDataFrame(made[:half], schema), spark.createDataFrame(made[half:], schema)
    got = load.upsert_by_key(base.repartition(7), increment, ["k"], ["version"])
    assert {tuple(row) for row in got.collect()} == brute_latest(made)


def test_increment_wins_without_version_and_on_equal_version(spark):
    base = spark.createDataFrame([(1, 5, "base"), (2, 5, "base"), (3, 9, "base")], "k int, v int, x string")
    increment = spark.createDataFrame([(1, 5, "new"), (3, 1, "new"), (4, 1, "new")], base.schema)
    plain = {(r["k"], r["x"]) for r in load.upsert_by_key(base, increment, ["k"]).collect()}
    assert plain == {(1, "new"), (2, "base"), (3, "new"), (4, "new")}
    versioned = {(r["k"], r["x"]) for r in load.upsert_by_key(base, increment, ["k"], ["v"]).collect()}
    assert versioned == {(1, "new"), (2, "base"), (3, "base"), (4, "new")}


@pytest.mark.parametrize("limit", [1000, 1])
def test_upsert_rewrites_touched_partitions_only(spark, rows, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(load, "LITERAL_LIMIT", limit)
    out = str(tmp_path)
    base = rows.withColumn("v", F.lit("base"))
    stage.stage_rows(stage.staged_rows(base, SPEC), out)
    before = {str(p): p.stat().st_mtime_ns for p in tmp_path.rglob("part-*")}
    increment = base.where("id % 5 IN (1, 2) AND id < 100").withColumn("v", F.lit("new"))
    for _ in range(2):
        load.upsert_table(spark, out, stage.staged_rows(increment, SPEC), ["id"], max_rows_per_file=25)
    back = staged.read_staged(spark, out, base.schema)
    expected = base.withColumn("v", F.when(F.expr("id % 5 IN (1, 2) AND id < 100"), "new").otherwise("base"))
    assert sorted(map(tuple, back.select("id", "v").collect())) == sorted(map(tuple, expected.select("id", "v").collect()))
    after = {str(p): p.stat().st_mtime_ns for p in tmp_path.rglob("part-*")}
    untouched = {p: t for p, t in before.items() if not any(f"pt=p{i}/" in p for i in (1, 2))}
    assert untouched.items() <= after.items()
    load.upsert_table(spark, out, stage.staged_rows(increment.limit(0), SPEC), ["id"])


def test_announced_file_that_is_missing_fails(spark, rows, job):
    plan.export_table(rows, SPEC, job)
    names = job.ledger(spark).current().select("task_name")
    gone = names.limit(1).select(F.concat("task_name", F.lit(".gone.parquet")).alias("task_name"))
    foreign = names.unionByName(gone).select(F.regexp_replace("task_name", "^file:", "s3:").alias("task_name"))
    status = {r["task_name"][-13:]: r["status"] for r in plan.import_announced(spark, foreign, rows.schema, SPEC, job).collect()}
    assert status.pop(".gone.parquet") == "IMPORTED FAILED" and set(status.values()) == {"IMPORTED SUCCESSFULLY"}
    assert plan.loaded_table(spark, rows.schema, SPEC, job).count() == rows.count()


def test_retry_finds_names_that_are_encoded(spark, job):
    rows = spark.createDataFrame([(i, f"{i % 2} - NOT %SPECIFIED") for i in range(10)], "id int, p string")
    spec = TableSpec("odd", partition="p", unique_key=("id",))
    plan.export_table(rows, spec, job)
    plan.import_table(spark, rows.schema, spec, job)
    assert plan.retry(spark, rows.schema, spec, job, partition="1 - NOT %SPECIFIED").count() >= 1
    with pytest.raises(ValueError):
        plan.retry(spark, rows.schema, spec, job, partition="2 - NOT %SPECIFIED")


def test_ledger_order_is_free_of_the_zone(spark, rows, job):
    plan.export_table(rows, SPEC, job)
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")
    try:
        plan.import_table(spark, rows.schema, SPEC, job)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    plan.import_table(spark, rows.schema, SPEC, job)
    assert plan.loaded_table(spark, rows.schema, SPEC, job).count() == rows.count()
    assert {r["status"] for r in job.ledger(spark).current().collect()} == {"IMPORTED SUCCESSFULLY"}


def test_many_open_loads_run_in_one_job(spark, rows, job):
    plan.export_table(rows, SPEC, job)
    record = job.ledger(spark)
    files = record.hold(record.current().select("task_name"))
    record.append(files, ledger.FAILED, load_id=F.concat(F.lit("load-"), F.xxhash64("task_name").cast("string")))
    plan.import_table(spark, rows.schema, SPEC, job)
    assert plan.loaded_table(spark, rows.schema, SPEC, job).count() == rows.count()
    assert {r["status"] for r in record.current().collect()} == {"IMPORTED SUCCESSFULLY"}


def test_reserved_names_are_refused(spark, job):
    with pytest.raises(ValueError, match="pt"):
        plan.export_table(spark.createDataFrame([(1, "a")], "id int, pt string"), TableSpec("t", partition="id"), job)


def test_equal_versions_give_the_same_row_each_time(spark):
    rows = spark.createDataFrame([(1, 5, f"v{i}") for i in range(50)], "k int, version int, v string")
    first = {r["v"] for n in (1, 3, 7) for r in load.latest_per_key(rows.repartition(n, "v"), ["k"], ["version"]).collect()}
    assert len(first) == 1
