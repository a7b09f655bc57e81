"""Inputs derived from the given tables, in Spark and in SQL. Each reads its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relocate.functions import times
from relocate.sources import catalog
from relocate.specs import TableSpec

ORDERS = TableSpec(
    name="orders",
    key="o_orderdate",
    unit="month",
    metrics={"o_totalprice": "o_totalprice"},
)
LINEITEM = TableSpec(
    name="lineitem",
    key="l_shipdate",
    unit="month",
    metrics={"l_extendedprice": "l_extendedprice", "l_quantity": "l_quantity"},
)
EVENTS = TableSpec(name="events", key="ts", unit="day", metrics={"value": "value"})
LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_VERSION = ("l_shipdate", "l_partkey", "l_suppkey")

# Damage done to the copy of a table that stands for the target.
LOST_MONTH = "p199703"
THINNED_MONTHS = ("p199601", "p199602")
CHANGED_MONTHS = ("p199801", "p199802", "p199803")
EXTRA_DATE = "2002-01-15"
THINNED_LINES = "p199705"

# Snapshot and delta of the events table; they overlap as under dual writing.
SNAPSHOT_END = "2024-01-20"
DELTA_START = "2024-01-15"

STATUS_OF = {
    "signup": "file uploaded to s3",
    "view": "IMPORTING",
    "purchase": "IMPORTED SUCCESSFULLY",
    "error": "IMPORTED FAILED",
    "click": "IMPORTED RETRY",
}
STATE_OF = {
    "signup": "PENDING",
    "view": "EXPORTING",
    "purchase": "FINISHED",
    "error": "CANCELLED",
    "click": "EXPORTING",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def mapped(column: str, values: dict[str, str]):
    """CASE over the fixed values of a column."""
    chosen = F.lit(None).cast("string")
    for value, result in values.items():
        chosen = F.when(F.col(column) == value, result).otherwise(chosen)
    return chosen


def sql_mapped(column: str, values: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{value}' THEN '{result}'" for value, result in values.items())
    return f"CASE {column} {cases} END"


# -- orders by month and its damaged copy -------------------------------------------------


def damaged_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumn("m", ORDERS.partition_column())
    thinned = F.col("m").isin(*THINNED_MONTHS) & (F.col("o_orderkey") % 7 == 0)
    changed = F.col("m").isin(*CHANGED_MONTHS) & (F.col("o_orderkey") % 5 == 0)
    kept = orders.where((F.col("m") != LOST_MONTH) & ~thinned).withColumn(
        "o_totalprice", F.when(changed, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    )
    extra = orders.where(F.col("o_orderkey") % 251 == 0).withColumn(
        "o_orderdate", F.lit(EXTRA_DATE).cast("timestamp_ntz")
    )
    return kept.unionByName(extra).drop("m")


SQL_MONTH = "strftime({}, 'p%Y%m')"
SQL_ORDERS = f"SELECT *, {SQL_MONTH.format('o_orderdate')} AS m FROM orders"
SQL_DAMAGED = f"""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN m IN {CHANGED_MONTHS} AND o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM ({SQL_ORDERS})
WHERE m <> '{LOST_MONTH}' AND NOT (m IN {THINNED_MONTHS} AND o_orderkey % 7 = 0)
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, TIMESTAMP '{EXTRA_DATE}', o_orderpriority
FROM orders WHERE o_orderkey % 251 = 0
"""


def sql_sum(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(30,6))) AS DECIMAL(38,6))"


def sql_month_metrics(rows: str) -> str:
    """Count and sum per month of an orders-like query."""
    return f"""
SELECT {SQL_MONTH.format('o_orderdate')} AS name, count(*) AS row_count, {sql_sum('o_totalprice')} AS o_totalprice
FROM ({rows}) GROUP BY 1"""


def thinned_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return lines.where(~((LINEITEM.partition_column() == THINNED_LINES) & (F.col("l_orderkey") % 7 == 0)))


SQL_THINNED_LINES = f"""
SELECT * FROM lineitem
WHERE NOT ({SQL_MONTH.format('l_shipdate')} = '{THINNED_LINES}' AND l_orderkey % 7 = 0)"""


# -- catalogs ------------------------------------------------------------------------------


def orders_catalog(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.calendar_catalog(table(spark, folder, "orders"), "o_orderdate", "month")


def lineitem_catalog(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.calendar_catalog(table(spark, folder, "lineitem"), "l_shipdate", "month")


def sql_month_catalog(rows: str, key: str) -> str:
    return f"""
SELECT strftime(s, 'p%Y%m') AS name, '{key}' AS key, 'range' AS ptype, CAST(s AS TIMESTAMP) AS start,
       CAST(s + INTERVAL 1 MONTH AS TIMESTAMP) AS "end", n AS rowcount
FROM (SELECT date_trunc('month', {key}) AS s, count(*) AS n FROM {rows} GROUP BY 1)"""


SQL_ORDERS_CATALOG = sql_month_catalog("orders", "o_orderdate")
SQL_LINEITEM_CATALOG = sql_month_catalog("lineitem", "l_shipdate")


def range_text(kind: str, low, high):
    return F.concat(
        F.lit(f"[types: [{kind}]; keys: ["), low, F.lit(f"]; ..types: [{kind}]; keys: ["), high, F.lit("]; )")
    )


def sql_range_text(kind: str, low: str, high: str) -> str:
    return f"'[types: [{kind}]; keys: [' || {low} || ']; ..types: [{kind}]; keys: [' || {high} || ']; )'"


def catalog_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Partition listing with texts: months of orders, sizes of parts, order states, priorities, one without bounds."""
    none = F.lit(None).cast("string")
    empty = F.lit("")
    months = orders_catalog(spark, folder).select(
        "name",
        "key",
        range_text("DATETIME", times.status_time(F.col("start")), times.status_time(F.col("end"))).alias("range"),
        none.alias("list"),
        "rowcount",
    )
    sizes = catalog.numeric_catalog(table(spark, folder, "part"), "p_size", 10, 1).select(
        "name",
        "key",
        range_text("INT", F.col("start").cast("string"), F.col("end").cast("string")).alias("range"),
        none.alias("list"),
        "rowcount",
    )
    orders = table(spark, folder, "orders")
    first, last = F.min("o_orderstatus"), F.max("o_orderstatus")
    states = (
        orders.groupBy(F.when(F.col("o_orderstatus") == "P", "popen").otherwise("pclosed").alias("name"))
        .agg(first.alias("first"), last.alias("last"), F.count("*").alias("rowcount"))
        .select(
            "name",
            F.lit("o_orderstatus").alias("key"),
            empty.alias("range"),
            F.when(F.col("first") == F.col("last"), F.concat(F.lit("("), "first", F.lit(")")))
            .otherwise(F.concat(F.lit("(("), "first", F.lit(", "), "last", F.lit("))")))
            .alias("list"),
            "rowcount",
        )
    )
    priorities = (
        orders.groupBy("o_orderpriority")
        .agg(F.count("*").alias("rowcount"))
        .select(
            F.concat(F.lit("p"), F.left("o_orderpriority", F.lit(1))).alias("name"),
            F.lit("o_orderpriority").alias("key"),
            empty.alias("range"),
            F.concat(F.lit('("'), "o_orderpriority", F.lit('")')).alias("list"),
            "rowcount",
        )
    )
    unbounded = orders.agg(F.count("*").alias("rowcount")).select(
        F.lit("pall").alias("name"),
        F.lit("o_orderdate").alias("key"),
        empty.alias("range"),
        empty.alias("list"),
        "rowcount",
    )
    return months.union(sizes).union(states).union(priorities).union(unbounded)


_SQL_MONTH_TEXT = sql_range_text(
    "DATETIME", "strftime(start, '%Y-%m-%d %H:%M:%S')", "strftime(\"end\", '%Y-%m-%d %H:%M:%S')"
)
_SQL_SIZE_TEXT = sql_range_text("INT", "CAST(s AS VARCHAR)", "CAST(s + 10 AS VARCHAR)")
SQL_TEXTS = f"""
SELECT name, key, {_SQL_MONTH_TEXT} AS range, NULL AS list, rowcount FROM ({SQL_ORDERS_CATALOG})
UNION ALL
SELECT 'p' || s, 'p_size', {_SQL_SIZE_TEXT}, NULL, n
FROM (SELECT ((p_size - 1) // 10) * 10 + 1 AS s, count(*) AS n FROM part GROUP BY 1)
UNION ALL
SELECT name, 'o_orderstatus', '', CASE WHEN a = b THEN '(' || a || ')' ELSE '((' || a || ', ' || b || '))' END, n
FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN 'popen' ELSE 'pclosed' END AS name,
             min(o_orderstatus) AS a, max(o_orderstatus) AS b, count(*) AS n FROM orders GROUP BY 1)
UNION ALL
SELECT 'p' || left(o_orderpriority, 1), 'o_orderpriority', '', '("' || o_orderpriority || '")', count(*)
FROM orders GROUP BY o_orderpriority
UNION ALL
SELECT 'pall', 'o_orderdate', '', '', count(*) FROM orders
"""


# -- events as ledger, messages, keys, snapshot and delta -----------------------------------


def task_names(events: DataFrame):
    """Task name of an event; job1 and job10 both occur."""
    return F.concat(
        F.lit("s3://b/stage/job"),
        (F.col("user_id") % 12).cast("string"),
        F.lit("/db/tb/p"),
        F.date_format("ts", "yyyyMMdd"),
        F.lit("/f"),
        F.col("user_id").cast("string"),
        F.lit(".parquet"),
    )


def ledger_events(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.select(
        task_names(events).alias("task_name"),
        mapped("event_type", STATUS_OF).alias("status"),
        F.col("ts").alias("update_time"),
        F.col("event_id").alias("seq"),
        F.lit("").alias("msg"),
        F.lit(None).cast("string").alias("load_id"),
    )


SQL_TASK = """
's3://b/stage/job' || (user_id % 12) || '/db/tb/p' || strftime(ts, '%Y%m%d') || '/f' || user_id || '.parquet'"""
SQL_LEDGER = f"""
SELECT {SQL_TASK} AS task_name, {sql_mapped('event_type', STATUS_OF)} AS status,
       ts AS update_time, event_id AS seq FROM events"""
SQL_STATE = f"""
SELECT task_name, status, update_time FROM ({SQL_LEDGER})
QUALIFY row_number() OVER (PARTITION BY task_name ORDER BY update_time DESC, seq DESC) = 1"""


def work_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Message texts: a sign-up stands for the end marker of its job, other events for a file."""
    from relocate.functions import messages

    events = table(spark, folder, "events")
    is_end = F.col("event_type") == "signup"
    job = F.concat(F.lit("job"), (F.col("user_id") % 12).cast("string"))
    return events.select(
        messages.message_body(
            F.when(is_end, messages.END_MARKER).otherwise(task_names(events)),
            times.status_time(F.col("ts")),
            F.when(is_end, job).otherwise(mapped("event_type", STATUS_OF)),
        ).alias("body")
    )


SQL_MESSAGES = f"""
SELECT CASE WHEN event_type = 'signup' THEN 'ALL TASK DONE' ELSE {SQL_TASK} END AS task_name,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS update_time,
       CASE WHEN event_type = 'signup' THEN 'job' || (user_id % 12) ELSE {sql_mapped('event_type', STATUS_OF)} END AS status,
       event_type = 'signup' AS is_end, 'job' || (user_id % 12) AS job
FROM events"""


def object_keys(spark: SparkSession, folder: str) -> DataFrame:
    """URL-encoded object keys below bucket ``b``: data files, temporary, hidden and foreign ones."""
    kind = F.col("event_id") % 7
    ident = F.col("user_id").cast("string")
    name = (
        F.when(kind == 2, F.concat(F.lit("f"), ident, F.lit(".csv")))
        .when(kind == 3, F.concat(F.lit("_temporary/f"), ident, F.lit(".parquet")))
        .when(kind == 4, F.concat(F.lit(".f"), ident, F.lit(".parquet")))
        .when(kind == 5, F.concat(F.lit("f"), ident, F.lit(".json")))
        .when(kind == 6, F.concat(F.lit("f%2B"), ident, F.lit("+x.parquet")))
        .otherwise(F.concat(F.lit("f"), ident, F.lit(".parquet")))
    )
    return table(spark, folder, "events").select(
        "event_id",
        F.concat(
            F.lit("stage/job"),
            (F.col("user_id") % 12).cast("string"),
            F.lit("/db/tb/p"),
            F.date_format("ts", "yyyyMMdd"),
            F.lit("/"),
            name,
        ).alias("key"),
    )


SQL_KEYS = """
SELECT event_id, 'stage/job' || (user_id % 12) || '/db/tb/p' || strftime(ts, '%Y%m%d') || '/' ||
  CASE event_id % 7 WHEN 2 THEN 'f' || user_id || '.csv' WHEN 3 THEN '_temporary/f' || user_id || '.parquet'
    WHEN 4 THEN '.f' || user_id || '.parquet' WHEN 5 THEN 'f' || user_id || '.json'
    WHEN 6 THEN 'f%2B' || user_id || '+x.parquet' ELSE 'f' || user_id || '.parquet' END AS key
FROM events"""


def snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").where(F.col("ts") < F.lit(SNAPSHOT_END).cast("timestamp_ntz"))


def delta(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").where(F.col("ts") >= F.lit(DELTA_START).cast("timestamp_ntz"))
    return events.withColumn("value", F.col("value") + 1)
