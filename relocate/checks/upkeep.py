"""What happens to a target table after its first load: purge, repeated exports, compaction, changes, and differences."""

from dataclasses import replace

from pyspark.sql import functions as F

from relocate.checks import fixtures as fx
from relocate.checks import query
from relocate.functions.paths import PARTITION_FIELD
from relocate.operators import changes, compact, differences, load, stage
from relocate.operators.loads import LoadLog
from relocate.plans import job as plan
from relocate.session import work_folder
from relocate.specs import Selector


def _job(spark, **settings):
    folders = [work_folder(spark, label) for label in ("stage", "target", "ledger")]
    return plan.Job("job1", "db", *folders, **settings)


def _moved(spark, rows, spec, job):
    plan.export_table(rows, spec, job)
    plan.import_table(spark, rows.schema, spec, job)


@query("purge_and_reload", "SELECT * FROM orders")
def purge_and_reload(spark, folder):
    """Two imports, a purge and a third import of everything, into a table without a key."""
    orders, job = fx.table(spark, folder, "orders"), _job(spark)
    for part in ("STARTWITH(p199801)", "ENDWITH(p199801)"):
        _moved(spark, orders, replace(fx.ORDERS, selector=Selector.parse(part)), job)
    plan.purge(spark, job)
    plan.import_table(spark, orders.schema, fx.ORDERS, job)
    return plan.loaded_table(spark, orders.schema, fx.ORDERS, job)


@query(
    "export_again_without_key",
    f"""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN {fx.SQL_MONTH.format('o_orderdate')} >= 'p200001' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders""",
)
def export_again_without_key(spark, folder):
    """Partitions that are exported and loaded again, and others retried by force, take the place of what was loaded."""
    orders, job = fx.table(spark, folder, "orders"), _job(spark)
    _moved(spark, orders, fx.ORDERS, job)
    late = replace(fx.ORDERS, selector=Selector.parse("STARTWITH(p200001)"))
    _moved(spark, orders.withColumn("o_totalprice", F.col("o_totalprice") + 1), late, job)
    plan.retry(spark, orders.schema, fx.ORDERS, job, partition="p199601")
    return plan.loaded_table(spark, orders.schema, fx.ORDERS, job)


def _loaded(rows, spec, folder, label):
    """Rows of a spec as one load of a target table."""
    log = LoadLog(rows.sparkSession, folder)
    log.begin(log.named(label))
    load.append_once(stage.gathered(stage.staged_rows(rows, spec), PARTITION_FIELD), folder, label)
    log.publish(log.named(label))


@query(
    "read_after_compaction",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 2 AS o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def read_after_compaction(spark, folder):
    """Three loads of the same keys merged into one; the keyed read then needs no shuffle."""
    orders, target = fx.table(spark, folder, "orders"), work_folder(spark, "target")
    for more in (0, 1, 2):
        _loaded(orders.withColumn("o_totalprice", F.col("o_totalprice") + more), fx.ORDERS, target, f"load{more}")
    compact.compact(spark, target, orders.schema, ["o_orderkey"], everything=True)
    return load.read_loaded(spark, target, orders.schema, ["o_orderkey"])


@query(
    "compact_by_size",
    f"SELECT 1 AS loads, {fx.SQL_MONTH.format('o_orderdate')} AS \"partition\", count(*) AS row_count FROM orders GROUP BY 2",
)
def compact_by_size(spark, folder):
    """Four loads of equal size in every month, merged in one round, without a key."""
    orders, target = fx.table(spark, folder, "orders"), work_folder(spark, "target")
    for quarter in range(4):
        _loaded(orders.where(F.col("o_orderkey") % 4 == quarter), fx.ORDERS, target, f"load{quarter}")
    compact.compact(spark, target, orders.schema, min_loads=2)
    sizes = compact.load_sizes(spark, target).groupBy(F.col(PARTITION_FIELD).alias("partition")).agg(F.count("*").cast("int").alias("loads"))
    rows = load.read_loaded(spark, target, orders.schema)
    counts = rows.groupBy(fx.ORDERS.partition_column().alias("partition")).agg(F.count("*").alias("row_count"))
    return counts.join(sizes, "partition").select("loads", "partition", "row_count")


@query(
    "apply_changes",
    """
SELECT user_id, event_id, ts, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AND event_type NOT IN ('error', 'click')""",
)
def apply_changes(spark, folder):
    """Events as changes of a user's row, errors and clicks as deletes, applied in three batches out of order, one of them twice."""
    events = fx.table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type", "value", "props")
    table = changes.ChangeTable(spark, work_folder(spark, "changes"), events.schema, ["user_id"], ["ts", "event_id"], "ts", "400 days", 16)
    batch = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for number in (2, 0, 0, 1):
        table.apply(events.where(batch == number), f"b{number}", "event_type IN ('error', 'click')")
    return table.rows()


@query(
    "apply_late_changes",
    f"""
SELECT count(*) AS late FROM events
WHERE ts < (SELECT max(ts) - INTERVAL 3 DAY FROM events WHERE ts < TIMESTAMP '{fx.SNAPSHOT_END}') AND event_id % 10 = 0""",
)
def apply_late_changes(spark, folder):
    """What comes later than the watermark allows is refused and named."""
    events = fx.table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type")
    table = changes.ChangeTable(spark, work_folder(spark, "changes"), events.schema, ["user_id"], ["ts", "event_id"], "ts", "3 days", 16)
    first = (F.col("ts") < F.lit(fx.SNAPSHOT_END).cast("timestamp_ntz")) & (F.col("event_id") % 10 != 0)
    table.apply(events.where(first), "first", "event_type = 'error'")
    return table.apply(events.where(~first), "second", "event_type = 'error'").agg(F.count("*").alias("late"))


_SQL_DIFFERENT = f"""
SELECT coalesce(s.m, t.m) AS "partition", o_orderkey, s.n AS src_rows, t.n AS tgt_rows,
       CASE WHEN t.n IS NULL THEN 'LOST' WHEN s.n IS NULL THEN 'EXTRA' ELSE 'NOT MATCH' END AS status,
       CASE WHEN t.n IS NOT NULL AND s.n IS NOT NULL THEN 'o_totalprice' END AS columns
FROM (SELECT m, o_orderkey, count(*) AS n, sum(o_totalprice::DECIMAL(18,2)) AS x FROM ({fx.SQL_ORDERS}) GROUP BY ALL) s
FULL JOIN (SELECT {fx.SQL_MONTH.format('o_orderdate')} AS m, o_orderkey, count(*) AS n, sum(o_totalprice::DECIMAL(18,2)) AS x
           FROM ({fx.SQL_DAMAGED}) GROUP BY ALL) t USING (m, o_orderkey)
WHERE s.n IS NULL OR t.n IS NULL OR s.n <> t.n OR s.x <> t.x"""


@query("differing_rows", _SQL_DIFFERENT)
def differing_rows(spark, folder):
    """The rows that the damaged copy of orders lost, changed or has too many."""
    orders = fx.table(spark, folder, "orders")
    return differences.differing_rows(orders, fx.damaged_orders(spark, folder), fx.ORDERS, ["o_orderkey"])
