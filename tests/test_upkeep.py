"""Target tables after their first load: purge, repeated loads, compaction, changes and differences."""

import datetime as dt
import random
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from relocate import Selector, TableSpec
from relocate.operators import changes, compact, differences, ledger, load, loads, stage
from relocate.plans import job as plan

SPEC = TableSpec("t", partition="p")


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


def moved(spark, rows, spec, job):
    plan.export_table(rows, spec, job)
    plan.import_table(spark, rows.schema, spec, job)


class Lost(RuntimeError):
    """The driver is lost."""


@pytest.fixture
def cutting(monkeypatch):
    """Loses the driver right before or after the n-th write from now on."""
    plain = DataFrameWriter.parquet

    def cut(turn, after):
        left = [turn]

        def write(self, path, *args, **named):
            left[0] -= 1
            if left[0] == 0 and not after:
                raise Lost()
            plain(self, path, *args, **named)
            if left[0] == 0:
                raise Lost()

        monkeypatch.setattr(DataFrameWriter, "parquet", write)
        return left

    yield cut
    monkeypatch.setattr(DataFrameWriter, "parquet", plain)


def repeated(cut, turn, after, step):
    """Run a step that is cut at a write, then whole; tells whether it was cut."""
    left = cut(turn, after)
    try:
        step()
    except Exception:
        assert left[0] <= 0
        left[0] = 10**9
        step()
        return True
    return left[0] <= 0


def test_purge_then_import_gives_each_row_once(spark, rows, job):
    for part in ("p0", "p3"):
        moved(spark, rows, replace(SPEC, selector=Selector.parse(f"EACH({part}, {part}x)")), job)
    assert loaded(spark, rows, job) == ids(rows.where("p IN ('p0', 'p3')"))
    plan.purge(spark, job)
    assert loaded(spark, rows, job) == []
    plan.export_table(rows, SPEC, job)
    for _ in range(2):
        plan.import_table(spark, rows.schema, SPEC, job)
    assert loaded(spark, rows, job) == list(range(300))


def test_purge_leaves_other_jobs_and_syncs_alone(spark, rows, job, tmp_path):
    from relocate.streaming import increments

    other, marks = replace(job, name="job2"), increments.HighWater(spark, f"{tmp_path}/marks")
    moved(spark, rows.where("id < 100"), SPEC, job)
    moved(spark, rows.where("id BETWEEN 100 AND 199"), SPEC, other)
    plan.sync_table(rows.where("id >= 200"), SPEC, "id", job, marks)
    state = job.ledger(spark).current()
    assert state.where(F.col("task_name").contains("/job1/db/t@")).count() > 0
    plan.purge(spark, job)
    assert loaded(spark, rows, job) == list(range(100, 300))
    assert job.ledger(spark).current().where(F.col("task_name").contains("/job1/")).count() == 0


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("turn", [2, 5, 7, 9])
def test_purge_and_import_cut_short(spark, rows, job, cutting, turn, after):
    moved(spark, rows, SPEC, job)
    repeated(cutting, turn % 3 + 1, after, lambda: plan.purge(spark, job))
    repeated(cutting, turn, after, lambda: plan.import_table(spark, rows.schema, SPEC, job))
    assert loaded(spark, rows, job) == list(range(300))
    assert {r["status"] for r in job.ledger(spark).current().collect()} == {ledger.LOADED}


@pytest.mark.parametrize("turn, after", [(5, True), (7, False), (8, True), (9, False), (10, True), (11, False)])
def test_export_again_cut_short(spark, rows, job, cutting, turn, after):
    moved(spark, rows, SPEC, job)
    newer = rows.where("p = 'p1'").withColumn("id", F.col("id") + 1000)
    plan.export_table(newer, SPEC, job)
    repeated(cutting, turn, after, lambda: plan.import_table(spark, rows.schema, SPEC, job))
    assert loaded(spark, rows, job) == sorted([*ids(rows.where("p <> 'p1'")), *ids(newer)])


def test_files_beside_a_reloaded_one_are_loaded_again(spark, rows, job):
    moved(spark, rows, SPEC, job)
    record = job.ledger(spark)
    one = record.hold(record.current().where(F.col("task_name").contains("pt=p2")).select("task_name").limit(1))
    record.append(one, ledger.RETRY)
    status = plan.import_table(spark, rows.schema, SPEC, job)
    assert status.count() == 2 and loaded(spark, rows, job) == list(range(300))


def test_unfinished_loads_are_not_shown(spark, rows, job, monkeypatch):
    plan.export_table(rows, SPEC, job)
    monkeypatch.setattr(loads.LoadLog, "publish", lambda *_, **__: (_ for _ in ()).throw(Lost()))
    with pytest.raises(Lost):
        plan.import_table(spark, rows.schema, SPEC, job)
    assert loaded(spark, rows, job) == []
    monkeypatch.undo()
    plan.import_table(spark, rows.schema, SPEC, job)
    assert loaded(spark, rows, job) == list(range(300))


@pytest.mark.parametrize("limit", [1000, 1])
def test_many_hidden_loads_are_joined(spark, rows, tmp_path, monkeypatch, limit):
    folder, log = str(tmp_path / "t"), loads.LoadLog(spark, str(tmp_path / "t"))
    for i in range(4):
        put(rows.where(f"id % 4 = {i}"), folder, f"l{i}")
    log.withdraw(log.named("l0"))
    log.withdraw(spark.createDataFrame([("l1", "p1"), ("l2", "p2")], "load_id string, pt string"))
    log.begin(log.named("l3"))
    monkeypatch.setattr(load, "LITERAL_LIMIT", limit)
    want = ids(rows.where("(id % 4 = 1 AND p <> 'p1') OR (id % 4 = 2 AND p <> 'p2')"))
    assert ids(load.read_loaded(spark, folder, rows.schema)) == want
    log.publish(log.named("l0", "l1", "l3"))
    assert ids(load.read_loaded(spark, folder, rows.schema)) == ids(rows.where("id % 4 <> 2 OR p <> 'p2'"))


# -- compaction -----------------------------------------------------------------------------


def put(rows, folder, label, spec=SPEC):
    log = loads.LoadLog(rows.sparkSession, folder)
    log.begin(log.named(label))
    load.append_once(stage.gathered(stage.staged_rows(rows, spec), "pt"), folder, label)
    log.publish(log.named(label))


def files(tmp_path):
    return {str(p) for p in tmp_path.rglob("part-*.parquet") if "load_id=" in str(p)}


def test_tiers(spark):
    mb = 1 << 20
    sizes = [("a", i, n) for i, n in enumerate([1, 2, mb, 3 * mb, 4 * mb, 70 * mb])] + [("b", i, 5 * mb) for i in range(3)] + [("c", 1, 0)]
    table = spark.createDataFrame([(f"l{i}", p, n) for p, i, n in sizes], "load_id string, pt string, bytes bigint")
    chosen = {(r["pt"], r["load_id"]) for r in compact.size_tiers(table, min_loads=3).collect()}
    assert chosen == {("a", f"l{i}") for i in range(4)} | {("b", f"l{i}") for i in range(3)}


@pytest.mark.parametrize("turn", [1, 2, 3, 4, 5])
@pytest.mark.parametrize("after", [False, True])
def test_compaction_cut_short(spark, rows, tmp_path, cutting, turn, after):
    folder, key = str(tmp_path / "t"), ["id"]
    versions = [rows.withColumn("v", F.lit(i)).where(f"id % 3 <> {i}") for i in range(3)]
    for i, some in enumerate(versions):
        put(some, folder, f"l{i}")
    schema = versions[0].schema
    want = {r["id"]: max(i for i in range(3) if r["id"] % 3 != i) for r in rows.collect()}
    read = lambda: {r["id"]: r["v"] for r in load.read_loaded(spark, folder, schema, key).collect()}
    left = cutting(turn, after)
    try:
        compact.compact(spark, folder, schema, key, everything=True)
    except Exception:
        left[0] = 10**9
        assert read() == want
        compact.compact(spark, folder, schema, key, everything=True)
    left[0] = 10**9
    assert read() == want
    text = load.read_loaded(spark, folder, schema, key)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "Exchange" not in text
    assert compact.compact(spark, folder, schema, key, everything=True).isEmpty()
    put(versions[0].withColumn("v", F.lit(9)).where("id < 10"), folder, "l9")
    assert read() == want | {i: 9 for i in range(10) if i % 3}


def test_compaction_keeps_repeated_rows_and_odd_names(spark, tmp_path):
    rows = spark.createDataFrame([(i % 4, f"{i % 2} - NOT %SPECIFIED") for i in range(40)], "id int, p string")
    folder = str(tmp_path / "t")
    for i in range(4):
        put(rows, folder, f"l{i}")
    assert compact.compact(spark, folder, rows.schema, min_loads=4).count() == 8
    assert ids(load.read_loaded(spark, folder, rows.schema)) == sorted(4 * ids(rows))
    assert compact.load_sizes(spark, folder).count() == 2
    assert compact.compact(spark, folder, rows.schema, min_loads=4).isEmpty()
    before = files(tmp_path)
    assert compact.vacuum(spark, folder, 0) == 0
    assert compact.vacuum(spark, folder, time.time_ns()) == 8
    assert len(files(tmp_path)) < len(before) and not [f for f in files(tmp_path) if "load_id=l" in f]
    assert ids(load.read_loaded(spark, folder, rows.schema)) == sorted(4 * ids(rows))


# -- changes --------------------------------------------------------------------------------

START = dt.datetime(2024, 1, 1)


def change_table(spark, folder, sample, keep, buckets=4):
    return changes.ChangeTable(spark, str(folder), sample.schema, ["k"], ["seq"], "at", keep, buckets)


def made(spark, count, keys=40, seed=1):
    chance = random.Random(seed)
    log = [(chance.choice([None, *range(keys)]), i, START + dt.timedelta(minutes=i), chance.choice("xyz"), chance.random() < 0.3) for i in range(count)]
    return log, spark.createDataFrame(log, "k int, seq int, at timestamp_ntz, v string, gone boolean")


def final(log):
    state = {}
    for k, seq, at, v, gone in sorted(log, key=lambda r: r[1]):
        state[k] = None if gone else (seq, v)
    return {k: s for k, s in state.items() if s}


def shown(table):
    got = table.rows().collect()
    state = {r["k"]: (r["seq"], r["v"]) for r in got}
    assert len(state) == len(got)
    return state


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_any_split_of_the_changes_gives_the_same_table(spark, tmp_path, batches):
    log, df = made(spark, 400)
    table = change_table(spark, tmp_path / "t", df.drop("gone"), "10 days")
    assert table.rows().count() == 0
    order = list(range(batches))
    random.Random(batches).shuffle(order)
    for n in order + order[:1]:
        late = table.apply(df.where(F.pmod(F.xxhash64("seq"), F.lit(batches)) == n), f"b{n}", "gone")
        assert late.count() == 0
    assert shown(table) == final(log)


def test_late_changes_are_refused_and_old_markers_go(spark, tmp_path):
    log, df = made(spark, 300, keys=5)
    table = change_table(spark, tmp_path / "t", df.drop("gone"), "30 minutes")
    assert table.apply(df.where("seq < 200 AND seq % 10 <> 0"), "one", "gone").count() == 0
    late = table.apply(df.where("seq >= 200 OR seq % 10 = 0"), "two", "gone")
    refused = {r["seq"] for r in late.collect()}
    assert refused == {s for s in range(0, 200, 10) if s < 199 - 30}
    assert shown(table) == final([r for r in log if r[1] not in refused])
    gone = spark.createDataFrame([(9, 1000, START + dt.timedelta(days=2), "x", True)], df.schema)
    table.apply(gone, "three", "gone")
    table.apply(gone.withColumn("k", F.lit(8)).withColumn("at", F.col("at") + F.expr("INTERVAL 2 DAYS")), "four", "gone")
    for k in range(5):
        table.apply(gone.withColumn("k", F.lit(k)).withColumn("at", F.col("at") + F.expr("INTERVAL 4 DAYS")), f"f{k}", "gone")
    assert shown(table).keys() <= {None}
    assert table._stored().where("_deleted AND at < '2024-01-03 00:01:00'").count() <= 5


@pytest.mark.parametrize("turn, after", [(1, True), (2, False), (3, True), (4, False), (4, True), (5, False), (6, True)])
def test_batch_cut_short(spark, tmp_path, cutting, turn, after):
    log, df = made(spark, 200, keys=10)
    table = change_table(spark, tmp_path / "t", df.drop("gone"), "10 days")
    table.apply(df.where("seq % 2 = 0"), "even", "gone")
    repeated(cutting, turn, after, lambda: table.apply(df.where("seq % 2 = 1"), "odd", "gone"))
    assert shown(table) == final(log)


def test_only_touched_buckets_are_written(spark, tmp_path):
    log, df = made(spark, 200, keys=30)
    table = change_table(spark, tmp_path / "t", df.drop("gone"), "10 days", 16)
    table.apply(df, "all", "gone")
    before = files(tmp_path)
    table.apply(df.where("k = 3").limit(1).withColumn("seq", F.lit(999)), "one", F.lit(False))
    assert len(files(tmp_path) - before) == 1


# -- differences ----------------------------------------------------------------------------


@pytest.mark.parametrize("leaf", [4096, 8])
def test_differing_rows_against_brute_force(spark, monkeypatch, leaf):
    monkeypatch.setattr(differences, "LEAF_ROWS", leaf)
    monkeypatch.setattr(differences, "LEVEL_BITS", 2)
    chance = random.Random(leaf)
    source = [(f"p{i % 4}", None if i % 50 == 0 else i // 2, chance.random(), chance.choice(["a", None])) for i in range(600)]
    target = []
    for p, k, v, w in source:
        pick = chance.random()
        if p == "p1" or pick < 0.9:
            target.append((p, k, v, w))
        elif pick < 0.93:
            target.append((p, k, v + 1, w))
        elif pick < 0.96:
            target.append((p, k, v, "b"))
    target += [("p2", 9999, 1.0, None), ("new", 1, 1.0, "x"), ("p1", 5000, 0.0, None)]
    schema = "p string, k int, v double, w string"
    spec = TableSpec("t", partition="p")
    got = differences.differing_rows(spark.createDataFrame(source, schema), spark.createDataFrame(target, schema), spec, ["k"]).collect()
    groups = {}
    for side, rows in enumerate((source, target)):
        for p, k, v, w in rows:
            groups.setdefault((p, k), ([], []))[side].append((v, w))
    want = {}
    order = lambda values: sorted(values, key=repr)
    for name, (a, b) in groups.items():
        columns = [c for i, c in enumerate(("v", "w")) if order(r[i] for r in a) != order(r[i] for r in b)]
        if not a or not b:
            want[name] = (len(a) or None, len(b) or None, "LOST" if a else "EXTRA", None)
        elif len(a) != len(b) or columns:
            names = [c for c in ("p", "k", "v", "w") if c in columns or len(a) != len(b) and (c == "p" or c == "k" and name[1] is not None)]
            want[name] = (len(a), len(b), "NOT MATCH", names)
    assert {(r["partition"], r["k"]) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        a, b, status, columns = want[r["partition"], r["k"]]
        assert (r["src_rows"], r["tgt_rows"], r["status"]) == (a, b, status)
        if columns is not None and a == b:
            assert r["columns"].split(",") == columns


def test_equal_tables_have_no_differing_rows(spark):
    rows = spark.range(5000).select("id", (F.col("id") % 7).cast("string").alias("p"))
    assert differences.differing_rows(rows, rows.repartition(3), SPEC, ["id"]).collect() == []


def test_only_differing_partitions_are_read_again(spark):
    from relocate.checks import fixtures as fx

    orders = fx.table(spark, "/root/testdata/sf0.001", "orders")
    found = spark.createDataFrame([("p199703", 0, 5)], "_pt string, _at bigint, _rows bigint")
    text = differences._narrowed(fx.ORDERS, found).rows(orders)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1997-03-01T00:00)" in text
