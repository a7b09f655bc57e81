"""Catalogs of ranges of any key: rows to partitions, faults, and a whole job by them."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.checks import fixtures as fx
from relocate.checks import query
from relocate.operators import intervals
from relocate.plans import catalogs
from relocate.plans import job as plan
from relocate.session import saved, work_folder
from relocate.sources import catalog


def _counted(df, keys, ranges, spark):
    listed = spark.createDataFrame(ranges, "name string, start string, end string")
    assigned = intervals.assign_by_bounds(df, keys, listed)
    return assigned.groupBy(F.col("pt").alias("name")).agg(F.count("*").alias("row_count"))


@query(
    "assign_text_ranges",
    """
SELECT CASE WHEN o_orderpriority < '2' THEN 'urgent' WHEN o_orderpriority < '4' THEN 'usual'
            WHEN o_orderpriority >= '4-NOT' AND o_orderpriority < '5' THEN 'none'
            WHEN o_orderpriority >= '5' THEN 'low' ELSE 'unassigned' END AS name, count(*) AS row_count
FROM orders GROUP BY 1""",
)
def assign_text_ranges(spark, folder):
    """Text bounds with open ends, a reversed range and an empty one."""
    ranges = [
        ("urgent", "MINVALUE", "2"),
        ("usual", "'2'", "'4'"),
        ("none", "4-NOT", "5"),
        ("low", "5", None),
        ("reversed", "9", "6"),
        ("empty", "7", "7"),
    ]
    return _counted(fx.table(spark, folder, "orders"), ["o_orderpriority"], ranges, spark)


@query(
    "assign_decimal_ranges",
    """
SELECT CASE WHEN p < 50000.55 THEN 'small' WHEN p >= 100000 AND p < 250000.01 THEN 'large' WHEN p >= 250000.01 THEN 'huge'
            ELSE 'unassigned' END AS name, count(*) AS row_count
FROM (SELECT CASE WHEN o_orderkey % 50 <> 7 THEN CAST(o_totalprice AS DECIMAL(15,2)) END AS p FROM orders) GROUP BY 1""",
)
def assign_decimal_ranges(spark, folder):
    """Decimal bounds with a gap and an unreadable entry; some rows have no key."""
    price = F.when(F.col("o_orderkey") % 50 != 7, F.col("o_totalprice").cast("decimal(15,2)"))
    ranges = [("small", None, "50000.55"), ("large", "100000", "250000.01"), ("huge", "250000.01", "MAXVALUE"), ("odd", "x", "1")]
    return _counted(fx.table(spark, folder, "orders").withColumn("price", price), ["price"], ranges, spark)


@query(
    "assign_compound_ranges",
    """
SELECT CASE WHEN (o_orderstatus, o_custkey) < ('F', 40) THEN 'a' WHEN (o_orderstatus, o_custkey) < ('O', 10) THEN 'b'
            WHEN o_orderstatus < 'P' THEN 'c' ELSE 'd' END AS name, count(*) AS row_count
FROM orders GROUP BY 1""",
)
def assign_compound_ranges(spark, folder):
    """Ranges of two columns, text and number; a bound that leaves out the second stands before all its values."""
    ranges = [("a", "MINVALUE,MINVALUE", "F,40"), ("b", "F, 40", "'O', 10"), ("c", "O,10", "P"), ("d", "P", "MAXVALUE, MAXVALUE")]
    return _counted(fx.table(spark, folder, "orders"), ["o_orderstatus", "o_custkey"], ranges, spark)


@query(
    "assign_many_text_ranges",
    """
SELECT coalesce(r.name, 'unassigned') AS name, count(*) AS row_count
FROM customer c LEFT JOIN (
    SELECT 'p' || c_custkey AS name, c_name AS low, coalesce(lead(c_name) OVER (ORDER BY c_name), '~') AS high
    FROM customer WHERE c_custkey % 3 = 1) r
ON c.c_name >= r.low AND c.c_name < r.high GROUP BY 1""",
)
def assign_many_text_ranges(spark, folder):
    """A range for every third customer name; the tree has more than one level."""
    customer = fx.table(spark, folder, "customer")
    following = F.col("c_custkey") + 3
    low = customer.where("c_custkey % 3 = 1").select(
        F.concat(F.lit("p"), F.col("c_custkey").cast("string")).alias("name"), F.col("c_name").alias("start"), following.alias("_next")
    )
    high = customer.select(F.col("c_custkey").alias("_next"), F.col("c_name").alias("end"))
    ranges = saved(low.join(high, "_next", "left").select("name", "start", "end"), "ranges")
    assigned = intervals.assign_by_bounds(customer, ["c_name"], ranges)
    return assigned.groupBy(F.col("pt").alias("name")).agg(F.count("*").alias("row_count"))


_SQL_FAULTY = f"""
SELECT name, CASE WHEN name = 'p199803' THEN "end" ELSE start END AS start,
       CASE WHEN name = 'p199803' THEN start WHEN month(start) % 5 = 0 THEN "end" + INTERVAL 40 DAY ELSE "end" END AS "end"
FROM ({fx.SQL_ORDERS_CATALOG}) WHERE name NOT IN ('p199607', 'p199608')
UNION ALL SELECT name || 'e', start, start FROM ({fx.SQL_ORDERS_CATALOG}) WHERE name LIKE 'p1999%'"""


@query(
    "catalog_faults",
    f"""
WITH c AS ({_SQL_FAULTY}), v AS (SELECT * FROM c WHERE start < "end"), pairs AS (
    SELECT b.name, any_value(b.start) AS start, any_value(b."end") AS "end",
           max(a."end") AS reach, max_by(a.name, (a."end", a.name)) AS other
    FROM v b JOIN v a ON (a.start, a."end", a.name) < (b.start, b."end", b.name) GROUP BY b.name
)
SELECT CASE WHEN start > "end" THEN 'reversed' ELSE 'empty' END AS fault, name, NULL::VARCHAR AS other,
       start::VARCHAR AS start, "end"::VARCHAR AS "end" FROM c WHERE start >= "end"
UNION ALL
SELECT 'overlap', name, other, start::VARCHAR, least("end", reach)::VARCHAR FROM pairs WHERE reach > start
UNION ALL
SELECT 'gap', name, other, reach::VARCHAR, start::VARCHAR FROM pairs WHERE reach < start""",
)
def catalog_faults(spark, folder):
    """The months of orders with two left out, some made longer, one turned round and empty entries beside."""
    months = fx.orders_catalog(spark, folder).select("name", "start", "end")
    turned, longer = F.col("name") == "p199803", F.month("start") % 5 == 0
    end = F.when(turned, F.col("start")).when(longer, F.col("end") + F.expr("INTERVAL 40 DAYS")).otherwise(F.col("end"))
    kept = months.where("name NOT IN ('p199607', 'p199608')")
    kept = kept.select("name", F.when(turned, F.col("end")).otherwise(F.col("start")).alias("start"), end.alias("end"))
    empty = months.where("name LIKE 'p1999%'").select(F.concat("name", F.lit("e")).alias("name"), "start", F.col("start").alias("end"))
    return intervals.catalog_faults(kept.unionByName(empty), [T.TimestampNTZType()])


@query(
    "catalog_list_faults",
    """
SELECT 'claimed twice' AS fault, min(name) AS name, max(name) AS other, value::VARCHAR AS start, NULL::VARCHAR AS "end"
FROM (SELECT DISTINCT 'p' || p_brand AS name, p_size AS value FROM part WHERE p_size > 25) GROUP BY value HAVING min(name) <> max(name)
UNION ALL SELECT DISTINCT 'unreadable', 'p' || p_brand, NULL, 'about ' || p_size, NULL FROM part WHERE p_size = 30""",
)
def catalog_list_faults(spark, folder):
    """Lists of the sizes that each brand has, so that most sizes are claimed twice, and a text among the numbers."""
    part = fx.table(spark, folder, "part").where("p_size > 25")
    name = F.concat(F.lit("p"), "p_brand").alias("name")
    size = F.col("p_size").cast("string")
    values = F.array_distinct(F.flatten(F.collect_set(F.when(F.col("p_size") == 30, F.array(size, F.concat(F.lit("about "), size))).otherwise(F.array(size)))))
    return intervals.list_faults(part.groupBy(name).agg(values.alias("values")), T.IntegerType())


# -- a job by catalogs ----------------------------------------------------------------------


def _listing(spark, rows, key):
    """A partition listing as the source's catalog writes it."""
    kind = "INT" if key == "p_size" else "VARCHAR"
    texts = [
        (name, key, f"[types: [{kind}]; keys: [{a}]; ..types: [{kind}]; keys: [{b}]; )" if listed is None else "", listed or "", "0")
        for name, a, b, listed in rows
    ]
    return catalog.parsed_catalog(spark.createDataFrame(texts, "name string, key string, range string, list string, rowcount string"), compound=True)


def _relocated(spark, folder, table, entries, metrics) -> DataFrame:
    rows = fx.table(spark, folder, table)
    spec = catalogs.catalog_spec(table, metrics)
    job = plan.Job("job1", "db", work_folder(spark, "stage"), work_folder(spark, "target"), work_folder(spark, "ledger"))
    source = catalogs.with_catalog(rows, entries)
    plan.export_table(source, spec, job)
    plan.import_table(spark, rows.schema, spec, job)
    target = catalogs.with_catalog(plan.loaded_table(spark, rows.schema, spec, job), entries)
    report = plan.validate([(spec, source, target)]).select("table", "name", "src_rows", "tgt_rows", "status")
    faulty = catalogs.faults(rows, entries).where("fault <> 'gap'").select(
        F.lit(table).alias("table"), "name", F.lit(None).cast("bigint").alias("src_rows"), F.lit(None).cast("bigint").alias("tgt_rows"), F.col("fault").alias("status")
    )
    return report.unionByName(faulty)


@query(
    "relocate_by_catalog",
    """
SELECT 'part' AS "table", CASE WHEN p_size < 10 THEN 'p0' WHEN p_size < 30 THEN 'p10' WHEN p_size >= 40 THEN 'p40' ELSE 'unassigned' END AS name,
       count(*) AS src_rows, count(*) AS tgt_rows, 'MATCH' AS status FROM part GROUP BY 2
UNION ALL
SELECT 'orders', CASE WHEN o_orderstatus = 'P' THEN 'popen' ELSE 'pclosed' END, count(*), count(*), 'MATCH' FROM orders GROUP BY 2
UNION ALL
SELECT 'customer', CASE WHEN (c_mktsegment, c_custkey) < ('F', 100) THEN 'first' ELSE 'last' END, count(*), count(*), 'MATCH'
FROM customer GROUP BY 2
UNION ALL SELECT 'part', 'pbad', NULL, NULL, 'reversed'
UNION ALL SELECT 'customer', 'none', NULL, NULL, 'empty'""",
)
def relocate_by_catalog(spark, folder):
    """Parts by ranges of size, orders by lists, customers by ranges of two columns: exported, loaded and compared."""
    sizes = _listing(spark, [("p0", "MINVALUE", "10", None), ("p10", "10", "30", None), ("p40", "40", "MAXVALUE", None), ("pbad", "90", "60", None)], "p_size")
    states = _listing(spark, [("popen", "", "", "(P)"), ("pclosed", "", "", "((F, O))")], "o_orderstatus")
    names = _listing(spark, [("first", "MINVALUE", "F,100", None), ("last", "F,100", "MAXVALUE", None), ("none", "Q,1", "Q,1", None)], "c_mktsegment,c_custkey")
    parts = [
        _relocated(spark, folder, "part", sizes, {"price": "p_retailprice"}),
        _relocated(spark, folder, "orders", states, {"price": "o_totalprice"}),
        _relocated(spark, folder, "customer", names, {"balance": "c_acctbal"}),
    ]
    return reduce(DataFrame.unionByName, parts)
