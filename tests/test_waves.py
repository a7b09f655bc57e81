"""Waves against a plain version: every row once, no wave above the cap, few and even waves."""

import random

import pytest
from pyspark.sql import functions as F

from relocate import TableSpec
from relocate.operators import sweep, waves
from relocate.plans import job as plan
from relocate.session import saved


def placed(df, cap):
    steps = waves.key_steps(df, F.col("p"), F.col("step"), F.col("size"))
    return saved(waves.place(steps, cap), "placed")


def table(spark, rows):
    return spark.createDataFrame(rows, "id bigint, p string, step bigint, size bigint")


def uneven(seed):
    """A partition with a third of all, a step with a tenth, missing names, steps and sizes."""
    draw = random.Random(seed)
    rows = []
    for i in range(1500):
        part = draw.choice(["big", "big", *"abcd", None])
        step = draw.choice([7, None, *range(40)]) if part != "big" else draw.choice([3, 3, 3, *range(200)])
        rows.append((i, part, step, draw.choice([0, None, 5, 40, 900])))
    return rows


@pytest.mark.parametrize("cap", [2_000, 20_000, 10**9])
def test_waves_hold_what_they_should(spark, cap):
    rows = uneven(cap)
    df = placed(table(spark, rows), cap)
    held, total = {}, sum(r[3] or 0 for r in rows)
    steps = {}
    for row in df.collect():
        held[row["wave"]] = held.get(row["wave"], 0) + row["bytes"]
        key = (row["partition"], row["step"])
        steps.setdefault(key, []).append((row["part"], row["parts"], row["bytes"]))
    assert sum(held.values()) == total and max(held.values()) <= cap
    assert sorted(held) == list(waves.numbers(df)) == list(range(len(held)))
    assert len(held) <= -(-total // cap) * 8 / 7 + 1
    assert len(held) == 1 or max(held.values()) - min(held.values()) < cap / 4
    assert set(steps) == {(r[1], r[2]) for r in rows}
    for key, parts in steps.items():
        assert sum(b for _, _, b in parts) == sum(r[3] or 0 for r in rows if (r[1], r[2]) == key)
        assert sorted(p for p, _, _ in parts) == list(range(parts[0][1]))
        assert max(b for _, _, b in parts) <= cap // waves.GRAIN


def test_waves_and_slices_follow_the_order_of_the_key(spark):
    found = waves.slices(placed(table(spark, uneven(1)), 20_000)).collect()
    order = sorted(found, key=lambda r: (r["partition"] or "", r["low"] if r["low"] is not None else -1, r["part"]))
    assert [r["wave"] for r in order] == sorted(r["wave"] for r in found)
    for name in {r["partition"] for r in found}:
        mine = [r for r in order if r["partition"] == name]
        assert [r["slice"] for r in mine] == list(range(len(mine)))
        ends = [(r["low"], r["high"]) for r in mine if r["low"] is not None and r["part"] == 0]
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


@pytest.mark.parametrize("limit", [100_000, 3])
def test_rows_of_all_waves_are_the_table(spark, limit, monkeypatch):
    monkeypatch.setattr(waves, "BROADCAST_STEPS", limit)
    df = table(spark, uneven(2))
    found = placed(df, 20_000)
    ids, sizes = [], {}
    for wave in waves.numbers(found):
        rows = waves.wave_rows(df, F.col("p"), F.col("step"), ["id"], found, wave).collect()
        ids += [r["id"] for r in rows]
        sizes[wave] = sum(r["size"] or 0 for r in rows)
    assert sorted(ids) == list(range(1500))
    assert max(sizes.values()) < 2 * 20_000


def test_bounds_of_a_wave_reach_the_scan(spark, tmp_path):
    table(spark, uneven(3)).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t").where("p IS NOT NULL")
    found = placed(df, 20_000)
    plan_text = waves.wave_rows(df, F.col("p"), F.col("step"), ["id"], found, 2)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(p," in plan_text and "LessThanOrEqual(p," in plan_text


def test_empty_and_weightless_tables(spark):
    empty = placed(table(spark, []), 100)
    assert empty.count() == 0 and list(waves.numbers(empty)) == []
    bare = placed(table(spark, [(1, "a", 1, 0), (2, None, None, None)]), 100)
    assert sorted((r["partition"] or "", r["wave"], r["slice"], r["bytes"]) for r in bare.collect()) == [("", 0, 0, 0), ("a", 0, 0, 0)]
    with pytest.raises(ValueError, match="16 bytes"):
        placed(table(spark, []), 3)


def test_sums_of_any_size(spark):
    rows = [(i, "p", i, 10**15 + i) for i in range(50)]
    found = placed(table(spark, rows), 10**16)
    assert found.agg(F.sum("bytes")).first()[0] == sum(r[3] for r in rows)
    assert found.groupBy("wave").agg(F.sum("bytes").alias("b")).agg(F.max("b")).first()[0] <= 10**16


def test_running_sum(spark):
    values = [random.Random(3).randrange(9) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "i bigint, v bigint")
    found = {r["i"]: r["s"] for r in sweep.running_sum(df, ["i"], F.col("v"), "s", "test").collect()}
    assert found == {i: sum(values[:i]) for i in range(500)}


def test_a_wave_that_is_moved_again_replaces_its_rows(spark, tmp_path):
    df = table(spark, uneven(4)).withColumn("p", F.coalesce("p", F.lit("none")))
    found = placed(df, 150_000)
    assert len(waves.numbers(found)) > 1
    spec = TableSpec("t", partition="p")
    job = plan.Job("job1", "db", f"{tmp_path}/stage", f"{tmp_path}/target", f"{tmp_path}/ledger")
    for wave in [*waves.numbers(found), 0]:
        plan.move_wave(waves.wave_rows(df, F.col("p"), F.col("step"), ["id"], found, wave), spec, job, wave)
    shown = plan.loaded_table(spark, df.schema, spec, job)
    assert sorted(r["id"] for r in shown.collect()) == list(range(1500))


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_jobs_do_not_grow_with_the_waves(spark, monkeypatch):
    from relocate.checks import waves as queries

    folder = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    jobs = {}
    for cap in (200_000, 20_000):
        monkeypatch.setattr(queries, "CAP", cap)
        found, jobs[cap] = jobs_of(spark, f"cap{cap}", lambda: queries.relocate_in_waves(spark, folder))
        assert found.exceptAll(documents).isEmpty() and documents.exceptAll(found).isEmpty()
    assert len(waves.numbers(queries._placed(documents, 20_000))) > 10
    assert jobs[20_000] < 1.5 * jobs[200_000]


@pytest.mark.parametrize("size", [1, 4, None])
def test_waves_of_a_round_are_staged_and_loaded_apart(spark, tmp_path, size):
    df = table(spark, uneven(5))
    found = placed(df, 60_000)
    spec, many = TableSpec("t", partition="p"), waves.numbers(found)
    job = plan.Job("job1", "db", f"{tmp_path}/stage", f"{tmp_path}/target", f"{tmp_path}/ledger")
    assert [w for some in waves.rounds(found, size) for w in some] == list(many) and len(many) > 4

    def move(some):
        rows = waves.round_rows(df, F.col("p"), F.col("step"), ["id"], found, some)
        return plan.move_waves(rows, spec, job, some).collect()

    for some in waves.rounds(found, size):
        assert sum(r["row_count"] for r in move(some)) > 0
    assert all(r["row_count"] == 0 for r in plan.import_table(spark, df.schema, spec, plan.replace(job, step="waves")).collect())
    ledger = job.ledger(spark).current().collect()
    loads, folders = {}, {}
    for row in ledger:
        wave = int(row["task_name"].split("/_wave=")[1].split("/")[0])
        loads.setdefault(wave, set()).add(row["load_id"])
        folders.setdefault(row["load_id"], set()).add(wave)
    assert sorted(loads) == list(many) and all(len(x) == 1 for x in [*loads.values(), *folders.values()])
    shown = plan.loaded_table(spark, df.schema, spec, job)
    assert sorted(r["id"] for r in shown.collect()) == list(range(1500))
    # one of them alone, then some together: each replaces its own rows
    plan.move_wave(waves.wave_rows(df, F.col("p"), F.col("step"), ["id"], found, 2), spec, job, 2)
    move(many[1:4])
    shown = plan.loaded_table(spark, df.schema, spec, job)
    assert shown.columns == df.columns and sorted(r["id"] for r in shown.collect()) == list(range(1500))
