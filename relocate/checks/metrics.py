"""Metrics and reconciliation of orders and lineitem with damaged copies."""

from dataclasses import replace

from pyspark.sql import functions as F

from relocate.checks import fixtures as fx
from relocate.checks import query
from relocate.operators import metrics, reconcile

_SRC = fx.sql_month_metrics("SELECT * FROM orders")
_TGT = fx.sql_month_metrics(fx.SQL_DAMAGED)


def _sql_compare(kind):
    return f"""
SELECT name, s.row_count AS src_rows, t.row_count AS tgt_rows,
       s.o_totalprice AS src_sum, t.o_totalprice AS tgt_sum,
       CASE WHEN t.row_count IS NULL THEN 'LOST' WHEN s.row_count IS NULL THEN 'EXTRA'
            WHEN s.row_count = t.row_count AND s.o_totalprice IS NOT DISTINCT FROM t.o_totalprice THEN 'MATCH'
            ELSE 'NOT MATCH' END AS status
FROM ({_SRC}) s {kind} JOIN ({_TGT}) t USING (name)"""


_SUM = replace(fx.ORDERS, metrics={"sum": "o_totalprice"})


def _orders(spark, folder):
    return fx.table(spark, folder, "orders")


@query(
    "partition_metrics",
    f"SELECT 'orders_' || name AS name, row_count, o_totalprice FROM ({_SRC})",
)
def partition_metrics(spark, folder):
    rows = metrics.partition_metrics(_orders(spark, folder), fx.ORDERS, prints=False)
    return metrics.named_for_table(rows, "orders")


@query(
    "table_metrics",
    f"SELECT 'orders' AS name, count(*) AS row_count, {fx.sql_sum('o_totalprice')} AS o_totalprice FROM orders",
)
def table_metrics(spark, folder):
    return metrics.table_metrics(_orders(spark, folder), fx.ORDERS)


@query("metric_fingerprint", f"SELECT name, row_count || ',' || o_totalprice AS fingerprint FROM ({_SRC})")
def metric_fingerprint(spark, folder):
    rows = metrics.partition_metrics(_orders(spark, folder), fx.ORDERS)
    return rows.select("name", metrics.fingerprint(F.col("row_count"), F.col("o_totalprice")).alias("fingerprint"))


@query("reconcile_left", _sql_compare("LEFT"))
def reconcile_left(spark, folder):
    return reconcile.reconcile(_orders(spark, folder), fx.damaged_orders(spark, folder), _SUM)


@query("reconcile_full", _sql_compare("FULL"))
def reconcile_full(spark, folder):
    return reconcile.reconcile(_orders(spark, folder), fx.damaged_orders(spark, folder), _SUM, both_sides=True)


_LINES = replace(fx.LINEITEM, metrics={"price": "l_extendedprice"})


@query(
    "reconcile_exact_doubles",
    f"""
SELECT {fx.SQL_MONTH.format('l_shipdate')} AS name, count(*) AS src_rows, count(*) AS tgt_rows,
       CASE WHEN bool_or(l_orderkey % 5 = 0 AND l_linenumber = 1) THEN 'NOT MATCH' ELSE 'MATCH' END AS status
FROM lineitem GROUP BY 1""",
)
def reconcile_exact_doubles(spark, folder):
    """Damage in the third digit of the first line of some orders."""
    lines = fx.table(spark, folder, "lineitem")
    damaged = F.when((F.col("l_orderkey") % 5 == 0) & (F.col("l_linenumber") == 1), F.col("l_extendedprice") + 0.001)
    target = lines.withColumn("l_extendedprice", F.coalesce(damaged, "l_extendedprice"))
    return reconcile.reconcile(lines, target, _LINES).select("name", "src_rows", "tgt_rows", "status")


_TYPED = replace(fx.ORDERS, metrics={"whole": "whole", "exact": "exact", "loose": "loose"})


@query(
    "reconcile_types",
    f"""
SELECT {fx.SQL_MONTH.format('o_orderdate')} AS name,
       CASE WHEN bool_or(o_orderkey % 50 = 0 OR o_orderkey % 77 = 1 OR o_orderkey % 91 = 2) THEN 'NOT MATCH' ELSE 'MATCH' END AS status
FROM orders GROUP BY 1""",
)
def reconcile_types(spark, folder):
    """Whole numbers against doubles, decimals against longer decimals and against doubles, each with small damage."""
    orders, key = _orders(spark, folder), F.col("o_orderkey")
    source = orders.withColumns({"whole": key, "exact": (key / 4).cast("decimal(18,2)"), "loose": (key / 4).cast("decimal(18,2)")})
    target = orders.withColumns(
        {
            "whole": key.cast("double") + F.when(key % 50 == 0, 0.4).otherwise(0.0),
            "exact": ((key / 4).cast("decimal(20,4)") + F.when(key % 77 == 1, F.lit("0.0049")).otherwise("0").cast("decimal(5,4)")),
            "loose": key / 4 + F.when(key % 91 == 2, 0.001).otherwise(0.0),
        }
    )
    return reconcile.reconcile(source, target, _TYPED).select("name", "status")


@query("reconcile_saved_metrics", _sql_compare("FULL"))
def reconcile_saved_metrics(spark, folder):
    """Comparison of two metric tables that were computed apart."""
    report = reconcile.compare_metrics(
        metrics.partition_metrics(_orders(spark, folder), _SUM),
        metrics.partition_metrics(fx.damaged_orders(spark, folder), _SUM),
        both_sides=True,
    )
    return report.withColumnsRenamed({"src_row_count": "src_rows", "tgt_row_count": "tgt_rows"})


def _report(spark, folder):
    return reconcile.reconcile_tables(
        [
            (fx.ORDERS, _orders(spark, folder), fx.damaged_orders(spark, folder)),
            (fx.LINEITEM, fx.table(spark, folder, "lineitem"), fx.thinned_lineitem(spark, folder)),
        ],
        both_sides=True,
    )


def _sql_line_metrics(rows):
    return f"""
SELECT {fx.SQL_MONTH.format('l_shipdate')} AS name, count(*) AS row_count,
       {fx.sql_sum('l_extendedprice')} || ',' || {fx.sql_sum('l_quantity')} AS vector
FROM ({rows}) GROUP BY 1"""


def _sql_report(table, src, tgt):
    return f"""
SELECT '{table}' AS "table", name, s.row_count AS src_rows, t.row_count AS tgt_rows,
       s.vector AS src_metrics, t.vector AS tgt_metrics,
       CASE WHEN t.row_count IS NULL THEN 'LOST' WHEN s.row_count IS NULL THEN 'EXTRA'
            WHEN s.row_count = t.row_count AND s.vector IS NOT DISTINCT FROM t.vector THEN 'MATCH'
            ELSE 'NOT MATCH' END AS status
FROM ({src}) s FULL JOIN ({tgt}) t USING (name)"""


def _as_vector(metrics_sql):
    return f"SELECT name, row_count, CAST(o_totalprice AS VARCHAR) AS vector FROM ({metrics_sql})"


_REPORT = (
    _sql_report("orders", _as_vector(_SRC), _as_vector(_TGT))
    + " UNION ALL "
    + _sql_report("lineitem", _sql_line_metrics("SELECT * FROM lineitem"), _sql_line_metrics(fx.SQL_THINNED_LINES))
)


@query("reconcile_multi_table", _REPORT)
def reconcile_multi_table(spark, folder):
    return _report(spark, folder)


@query(
    "mismatch_summary",
    f"""
SELECT "table", count(*) AS checked, count_if(status <> 'MATCH')::BIGINT AS mismatched,
       bool_and(status = 'MATCH') AS all_right
FROM ({_REPORT}) GROUP BY 1""",
)
def mismatch_summary(spark, folder):
    return reconcile.summary(_report(spark, folder))


@query("mismatch_names", f"""SELECT "table", name, status FROM ({_REPORT}) WHERE status <> 'MATCH'""")
def mismatch_names(spark, folder):
    return reconcile.mismatches(_report(spark, folder)).select("table", "name", "status")
