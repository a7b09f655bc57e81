"""Queries that write to a new folder below the shared one, read back and return what is there."""

from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.checks import fixtures as fx
from relocate.checks import query
from relocate.functions.paths import PARTITION_FIELD
from relocate.operators import ledger, load, stage
from relocate.plans import job as plan
from relocate.session import saved, work_folder
from relocate.sources import listing, staged
from relocate.specs import Layout, Selector, Store, TableSpec

_ORDERS_STAGED = f"SELECT *, {fx.SQL_MONTH.format('o_orderdate')} AS pt FROM orders"
_EVENTS_STAGED = "SELECT *, strftime(ts, 'p%Y%m%d') AS pt FROM events"

_TEXT = staged.text_format()

# Row cap small enough that every scale writes several files per partition.
_CAP = 100


def _stage_orders(spark, folder, max_rows=0, layout=Layout()):
    orders = fx.table(spark, folder, "orders")
    out = work_folder(spark, "stage")
    stage.stage_rows(stage.staged_rows(orders, fx.ORDERS), out, max_rows, layout)
    return orders, out


@query("stage_parquet", _ORDERS_STAGED)
def stage_parquet(spark, folder):
    orders, out = _stage_orders(spark, folder)
    return staged.read_staged(spark, out, orders.schema)


@query(
    "stage_parquet_lineitem",
    f"""
SELECT {fx.SQL_MONTH.format('l_shipdate')} AS "partition", count(*) AS row_count,
       {fx.sql_sum('l_extendedprice')} AS l_extendedprice FROM lineitem GROUP BY 1""",
)
def stage_parquet_lineitem(spark, folder):
    """The large table staged by month, read back as metrics."""
    lines = fx.table(spark, folder, "lineitem")
    out = work_folder(spark, "stage")
    stage.stage_rows(stage.staged_rows(lines, fx.LINEITEM), out, 1_000_000)
    rows = staged.read_staged(spark, out, lines.schema)
    price = F.sum(F.col("l_extendedprice").cast("decimal(30,6)")).cast("decimal(38,6)")
    return rows.groupBy(F.col(PARTITION_FIELD).alias("partition")).agg(
        F.count("*").alias("row_count"), price.alias("l_extendedprice")
    )


@query(
    "stage_row_cap",
    f"""
SELECT {fx.SQL_MONTH.format('o_orderdate')} AS name, count(*) AS row_count, true AS within_cap
FROM orders GROUP BY 1""",
)
def stage_row_cap(spark, folder):
    orders, out = _stage_orders(spark, folder, _CAP)
    rows = staged.with_file(staged.read_staged(spark, out, orders.schema))
    files = rows.groupBy(PARTITION_FIELD, "task_name").agg(F.count("*").alias("n"))
    return files.groupBy(F.col(PARTITION_FIELD).alias("name")).agg(
        F.sum("n").alias("row_count"), (F.max("n") <= _CAP).alias("within_cap")
    )


@query(
    "stage_overwrite_one",
    f"""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN pt = 'p199601' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority, pt
FROM ({_ORDERS_STAGED})""",
)
def stage_overwrite_one(spark, folder):
    """One partition staged again with other values; the rest stays."""
    orders, out = _stage_orders(spark, folder)
    spec = replace(fx.ORDERS, selector=Selector.parse("EACH(p199601)"))
    changed = stage.staged_rows(orders.withColumn("o_totalprice", F.col("o_totalprice") + 1), spec)
    stage.stage_rows(changed, out)
    return staged.read_staged(spark, out, orders.schema)


@query("stage_from_folders", _ORDERS_STAGED)
def stage_from_folders(spark, folder):
    """A source of partition folders staged again without a shuffle."""
    orders, source = _stage_orders(spark, folder)
    out = work_folder(spark, "stage")
    stage.stage_rows(staged.read_staged(spark, source, orders.schema), out, gather=False)
    return staged.read_staged(spark, out, orders.schema)


@query("stage_layout", _ORDERS_STAGED)
def stage_layout(spark, folder):
    """Bloom filters and LZ4 compression, as the tables of the source have them."""
    orders, out = _stage_orders(spark, folder, layout=Layout("lz4_raw", ("o_orderkey", "o_custkey")))
    return staged.read_staged(spark, out, orders.schema)


@query("stage_bucketed", "SELECT o_custkey, count(*) AS row_count FROM orders GROUP BY o_custkey")
def stage_bucketed(spark, folder):
    """A table bucketed by customer; the count by customer then needs no shuffle."""
    out = work_folder(spark, "bucketed")
    name = "relocate_" + out.rsplit("-", 1)[1]
    layout = Layout(bucket_columns=("o_custkey",), buckets=8)
    stage.save_bucketed(fx.table(spark, folder, "orders"), name, out, layout)
    return spark.table(name).groupBy("o_custkey").agg(F.count("*").alias("row_count"))


@query("read_staged_parquet", f"SELECT * FROM ({_ORDERS_STAGED}) WHERE pt >= 'p199801' AND pt < 'p199804'")
def read_staged_parquet(spark, folder):
    """Partitions of a staged table; the scan opens their folders only."""
    orders, out = _stage_orders(spark, folder)
    rows = staged.read_staged(spark, out, orders.schema)
    return rows.where(Selector.parse("RANGE(p199801,p199804)").keeps(PARTITION_FIELD))


@query("stage_delimited", _EVENTS_STAGED)
def stage_delimited(spark, folder):
    events = fx.table(spark, folder, "events")
    out = work_folder(spark, "text")
    stage.stage_rows(stage.staged_rows(events, fx.EVENTS), out, 1000, stage_format=_TEXT)
    return staged.read_staged(spark, out, events.schema, _TEXT)


@query("read_staged_delimited", _ORDERS_STAGED)
def read_staged_delimited(spark, folder):
    """Text that holds no line breaks, so that large files can be split."""
    orders = fx.table(spark, folder, "orders")
    out = work_folder(spark, "text")
    plain = staged.text_format(line_breaks=False)
    stage.stage_rows(stage.staged_rows(orders, fx.ORDERS), out, stage_format=plain)
    return staged.read_staged(spark, out, orders.schema, plain)


@query("stage_delimited_documents", "SELECT * FROM documents")
def stage_delimited_documents(spark, folder):
    """Long texts with line breaks and quotes, unchanged by the text format."""
    documents = fx.table(spark, folder, "documents")
    out = work_folder(spark, "text")
    stage.stage_rows(stage.staged_rows(documents, TableSpec("documents", "lang")), out, 1000, stage_format=_TEXT)
    return staged.read_staged(spark, out, documents.schema, _TEXT).select(*documents.columns)


@query("column_mapping", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def column_mapping(spark, folder):
    """Headerless text whose columns are in another order than the table's."""
    events = fx.table(spark, folder, "events")
    order = ["props", "user_id", "ts", "event_id", "value", "event_type"]
    out = work_folder(spark, "text")
    rows = stage.staged_rows(events, fx.EVENTS).select(*order, PARTITION_FIELD)
    plain = staged.text_format(staged.PLAIN_SEPARATOR)
    stage.stage_rows(rows, out, stage_format=plain)
    file_schema = T.StructType([events.schema[name] for name in order])
    return staged.read_staged(spark, out, file_schema, plain).select(*events.columns)


@query(
    "staged_file_counts",
    f"SELECT {fx.SQL_MONTH.format('o_orderdate')} AS \"partition\", count(*) AS row_count FROM orders GROUP BY 1",
)
def staged_file_counts(spark, folder):
    """Rows per file, added up per partition because file names are random."""
    orders, out = _stage_orders(spark, folder, 10 * _CAP)
    counts = load.file_counts(staged.read_staged(spark, out, orders.schema))
    partition = F.regexp_extract("task_name", f"/{PARTITION_FIELD}=([^/]*)/", 1)
    return counts.groupBy(partition.alias("partition")).agg(F.sum("row_count").alias("row_count"))


@query("direct_copy", "SELECT * FROM orders WHERE o_orderstatus <> 'P'")
def direct_copy(spark, folder):
    spec = replace(fx.ORDERS, row_filter="o_orderstatus <> 'P'")
    target = Store(root=work_folder(spark, "copy"))
    orders = fx.table(spark, folder, "orders")
    load.direct_copy(orders, spec, target)
    return target.read(spark, "orders", orders.schema)


def _job(spark, name, **settings):
    return plan.Job(
        name, "db", work_folder(spark, "stage"), work_folder(spark, "target"), work_folder(spark, "ledger"), **settings
    )


@query("load_append", "SELECT * FROM orders")
def load_append(spark, folder):
    """Exported, then loaded twice; the second load finds nothing to do."""
    orders = fx.table(spark, folder, "orders")
    spec = fx.ORDERS
    job = _job(spark, "job1")
    plan.export_table(orders, spec, job)
    plan.import_table(spark, orders.schema, spec, job)
    plan.import_table(spark, orders.schema, spec, job)
    return plan.loaded_table(spark, orders.schema, spec, job)


@query("load_append_delimited", "SELECT * FROM events")
def load_append_delimited(spark, folder):
    """The same job over delimited text."""
    events = fx.table(spark, folder, "events")
    job = _job(spark, "job1", max_rows_per_file=5000, stage_format=_TEXT)
    plan.export_table(events, fx.EVENTS, job)
    plan.import_table(spark, events.schema, fx.EVENTS, job)
    return plan.loaded_table(spark, events.schema, fx.EVENTS, job)


@query(
    "upsert_by_key",
    """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
)
def upsert_by_key(spark, folder):
    """Returned lines as the increment over the others; the highest version of a key wins."""
    lines = fx.table(spark, folder, "lineitem")
    returned = F.col("l_returnflag") == "R"
    return load.upsert_by_key(lines.where(~returned), lines.where(returned), fx.LINE_KEY, fx.LINE_VERSION)


@query("upsert_table", "SELECT event_id, ts, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN value + 1 ELSE value END AS value FROM events")
def upsert_table(spark, folder):
    """Delta merged into a stored snapshot; days before the delta are not touched."""
    out = work_folder(spark, "upsert")
    stage.stage_rows(stage.staged_rows(fx.snapshot(spark, folder), fx.EVENTS), out)
    increment = stage.staged_rows(fx.delta(spark, folder), fx.EVENTS)
    load.upsert_table(spark, out, increment, ["event_id"])
    return spark.read.schema(increment.schema).parquet(out).select("event_id", "ts", "value")


@query(
    "snapshot_plus_delta",
    "SELECT event_id, ts, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN value + 1 ELSE value END AS value FROM events",
)
def snapshot_plus_delta(spark, folder):
    merged = load.upsert_by_key(fx.snapshot(spark, folder), fx.delta(spark, folder), ["event_id"])
    return merged.select("event_id", "ts", "value")


@query("retry_replay", "SELECT * FROM orders")
def retry_replay(spark, folder):
    """A load whose record says that every second month failed, loaded again; each row shows once."""
    orders = fx.table(spark, folder, "orders")
    spec = replace(fx.ORDERS, unique_key=("o_orderkey",))
    job = _job(spark, "job1")
    plan.export_table(orders, spec, job)
    plan.import_table(spark, orders.schema, spec, job)
    record = job.ledger(spark)
    month = F.regexp_extract("task_name", f"/{PARTITION_FIELD}=p([0-9]+)/", 1).cast("int")
    record.append(record.hold(record.current().where(month % 2 == 1).select("task_name")), ledger.FAILED)
    plan.retry(spark, orders.schema, spec, job)
    return plan.loaded_table(spark, orders.schema, spec, job)


@query(
    "landed_staged_files",
    f"SELECT {fx.SQL_MONTH.format('o_orderdate')} AS \"partition\", true AS has_bytes FROM orders GROUP BY 1",
)
def landed_staged_files(spark, folder):
    """Files found by listing the stage, one entry per partition."""
    _, out = _stage_orders(spark, folder)
    partition = F.regexp_extract("task_name", f"/{PARTITION_FIELD}=([^/]*)/", 1)
    files = listing.list_files(spark, out)
    return files.groupBy(partition.alias("partition")).agg(F.bool_and(F.col("length") > 0).alias("has_bytes"))


@query(
    "relocate_and_validate",
    f"""
SELECT 'orders' AS "table", {fx.SQL_MONTH.format('o_orderdate')} AS name, count(*) AS src_rows, count(*) AS tgt_rows,
       CAST({fx.sql_sum('o_totalprice')} AS VARCHAR) AS src_metrics,
       CAST({fx.sql_sum('o_totalprice')} AS VARCHAR) AS tgt_metrics, 'MATCH' AS status
FROM orders WHERE {fx.SQL_MONTH.format('o_orderdate')} >= 'p199801' GROUP BY 2""",
)
def relocate_and_validate(spark, folder):
    """A whole job: export from 1998 on, load, compare with the source under the same spec."""
    orders = fx.table(spark, folder, "orders")
    spec = replace(fx.ORDERS, selector=Selector.parse("STARTWITH(p199801)"))
    job = _job(spark, "job1", max_rows_per_file=10_000)
    plan.export_table(orders, spec, job)
    plan.import_table(spark, orders.schema, spec, job)
    return plan.validate([(spec, orders, plan.loaded_table(spark, orders.schema, spec, job))])


@query("load_announced_files", f"SELECT {fx.SQL_MONTH.format('o_orderdate')} AS \"partition\", count(*) AS row_count FROM orders GROUP BY 1 UNION ALL SELECT 'gone', 0")
def load_announced_files(spark, folder):
    """Files that storage events announced, under another scheme and with encoded names, and one that is not there."""
    orders = fx.table(spark, folder, "orders")
    job = _job(spark, "job1")
    plan.export_table(orders, fx.ORDERS, job)
    raw = F.regexp_replace("task_name", "^[a-z0-9]+:/+", "")
    names = job.ledger(spark).current().select(raw.alias("name"))
    gone = names.limit(1).select(F.regexp_replace("name", f"{PARTITION_FIELD}=[^/]*", f"{PARTITION_FIELD}=gone").alias("name"))
    keys = names.unionByName(gone).select(F.regexp_replace("name", "=", "%3D").alias("raw_path"))
    done = plan.import_announced(spark, listing.landed_files(keys), orders.schema, fx.ORDERS, job)
    partition = F.regexp_extract("task_name", f"/{PARTITION_FIELD}=([^/]*)/", 1)
    report = done.groupBy(partition.alias("partition")).agg(F.sum("row_count").alias("row_count"))
    return saved(report, "announced")
