"""Scans, partition predicates and the assignment of rows to partitions."""

from dataclasses import replace

from pyspark.sql import functions as F

from relocate.checks import fixtures as fx
from relocate.checks import query
from relocate.operators import assign, predicates
from relocate.session import saved
from relocate.specs import Selector, Store

# List partitions of orders by state.
STATE_LISTS = {"pclosed": ["F", "O"], "popen": ["P"]}

_OPEN_OR_LARGE = "o_orderstatus = 'P' OR o_totalprice > 400000"


def _orders(spark, folder):
    return fx.table(spark, folder, "orders")


@query(
    "scan_filtered",
    """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1996-04-01' AND o_orderstatus = 'F'""",
)
def scan_filtered(spark, folder):
    """One partition of a stored table with a row filter and two columns."""
    source = Store(format="parquet", root=folder)
    rows = predicates.partition_rows(
        source.read(spark, "orders.parquet"),
        "o_orderdate",
        "1996-03-01",
        "1996-04-01",
        row_filter="o_orderstatus = 'F'",
    )
    return rows.select("o_orderkey", "o_totalprice")


@query("scan_whole_table", f"SELECT * FROM orders WHERE {_OPEN_OR_LARGE}")
def scan_whole_table(spark, folder):
    spec = replace(fx.ORDERS, row_filter=_OPEN_OR_LARGE, selector=Selector.parse("ALL"))
    return spec.rows(_orders(spark, folder))


@query("select_all", "SELECT * FROM orders")
def select_all(spark, folder):
    spec = replace(fx.ORDERS, selector=Selector.parse("ALL"))
    return spec.rows(_orders(spark, folder))


@query("filter_range_number", "SELECT * FROM part WHERE p_size >= 11 AND p_size < 21")
def filter_range_number(spark, folder):
    return predicates.partition_rows(fx.table(spark, folder, "part"), "p_size", "11", "21")


@query(
    "filter_range_date",
    "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1996-04-01'",
)
def filter_range_date(spark, folder):
    return predicates.partition_rows(
        _orders(spark, folder), "o_orderdate", "1996-03-01 00:00:00", "1996-04-01 00:00:00"
    )


@query("filter_list_single", "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'")
def filter_list_single(spark, folder):
    return predicates.partition_rows(_orders(spark, folder), "o_orderpriority", values=["1-URGENT"])


@query("filter_list_in", "SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O')")
def filter_list_in(spark, folder):
    return predicates.partition_rows(_orders(spark, folder), "o_orderstatus", values=STATE_LISTS["pclosed"])


@query(
    "filter_data_conjunct",
    f"""
SELECT * FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-02-01' AND ({_OPEN_OR_LARGE})""",
)
def filter_data_conjunct(spark, folder):
    return predicates.partition_rows(
        _orders(spark, folder), "o_orderdate", "1997-01-01", "1997-02-01", row_filter=_OPEN_OR_LARGE
    )


@query(
    "filter_within_bounds",
    "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-05-01' AND o_orderdate < TIMESTAMP '1998-08-01'",
)
def filter_within_bounds(spark, folder):
    """Selected partitions as one pushed range, for a table without partition folders."""
    orders = _orders(spark, folder)
    chosen = fx.orders_catalog(spark, folder).where(Selector.parse("RANGE(p199805,p199808)").keeps("name"))
    return predicates.within_bounds(orders, "o_orderdate", chosen)


@query(
    "assign_range_partition",
    """
SELECT CASE WHEN p_size >= 1 AND p_size < 41 THEN 'p' || (((p_size - 1) // 10) * 10 + 1) ELSE 'unassigned' END AS name,
       count(*) AS row_count
FROM part GROUP BY 1""",
)
def assign_range_partition(spark, folder):
    """The last range is left out of the catalog, so its rows are unassigned."""
    ranges = spark.createDataFrame(
        [(f"p{low}", low, low + 10) for low in range(1, 41, 10)], "name string, start int, end int"
    )
    assigned = assign.assign_ranges(fx.table(spark, folder, "part"), "p_size", ranges)
    return assigned.groupBy(F.col("pt").alias("name")).agg(F.count("*").alias("row_count"))


@query(
    "assign_range_partition_date",
    f"""
SELECT CASE WHEN l_shipdate < TIMESTAMP '2001-06-01' THEN {fx.SQL_MONTH.format('l_shipdate')}
            ELSE 'unassigned' END AS name, count(*) AS row_count
FROM lineitem GROUP BY 1""",
)
def assign_range_partition_date(spark, folder):
    """Months of lineitem from a stored catalog that ends before the data does."""
    ranges = saved(
        fx.lineitem_catalog(spark, folder).where(Selector.parse("ENDWITH(p200106)").keeps("name")), "catalog"
    )
    assigned = assign.assign_ranges(fx.table(spark, folder, "lineitem"), "l_shipdate", ranges)
    return assigned.groupBy(F.col("pt").alias("name")).agg(F.count("*").alias("row_count"))


@query(
    "assign_range_uneven",
    f"""
SELECT CASE WHEN l_shipdate < TIMESTAMP '1999-01-01' THEN {fx.SQL_MONTH.format('l_shipdate')} ELSE 'pmax' END AS name,
       count(*) AS row_count
FROM lineitem GROUP BY 1""",
)
def assign_range_uneven(spark, folder):
    """Months of lineitem, and one range that holds all later dates up to the year 9999."""
    months = fx.lineitem_catalog(spark, folder).where(Selector.parse("ENDWITH(p199901)").keeps("name"))
    last = spark.sql("SELECT 'pmax' AS name, TIMESTAMP_NTZ'1999-01-01' AS start, TIMESTAMP_NTZ'9999-01-01' AS end")
    ranges = saved(months.select("name", "start", "end").unionByName(last), "catalog")
    assigned = assign.assign_ranges(fx.table(spark, folder, "lineitem"), "l_shipdate", ranges)
    return assigned.groupBy(F.col("pt").alias("name")).agg(F.count("*").alias("row_count"))


@query(
    "assign_list_partition",
    """
SELECT CASE WHEN o_orderstatus IN ('F', 'O') THEN 'pclosed' WHEN o_orderstatus = 'P' THEN 'popen'
            ELSE 'unassigned' END AS name, count(*) AS row_count
FROM orders GROUP BY 1""",
)
def assign_list_partition(spark, folder):
    lists = spark.createDataFrame(list(STATE_LISTS.items()), "name string, values array<string>")
    assigned = assign.assign_lists(_orders(spark, folder), "o_orderstatus", lists)
    return assigned.groupBy(F.col("pt").alias("name")).agg(F.count("*").alias("row_count"))
