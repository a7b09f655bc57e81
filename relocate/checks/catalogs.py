"""Partition catalogs and selections."""

from pyspark.sql import functions as F

from relocate.checks import fixtures as fx
from relocate.checks import query
from relocate.functions import bounds
from relocate.operators import select
from relocate.session import saved
from relocate.sources import catalog
from relocate.specs import Selector, split_selectors

_CATALOG = fx.SQL_ORDERS_CATALOG


@query("partition_catalog", _CATALOG)
def partition_catalog(spark, folder):
    return fx.orders_catalog(spark, folder)


@query(
    "partition_catalog_numeric",
    """
SELECT 'p' || s AS name, 'p_size' AS key, 'range' AS ptype, CAST(s AS BIGINT) AS start,
       CAST(s + 10 AS BIGINT) AS "end", count(*) AS rowcount
FROM (SELECT ((p_size - 1) // 10) * 10 + 1 AS s FROM part) GROUP BY s""",
)
def partition_catalog_numeric(spark, folder):
    return catalog.numeric_catalog(fx.table(spark, folder, "part"), "p_size", 10, 1)


@query("catalog_sorted", f"{_CATALOG} ORDER BY name")
def catalog_sorted(spark, folder):
    return select.sorted_catalog(fx.orders_catalog(spark, folder))


@query(
    "catalog_key_mismatch",
    f"""
SELECT name, key, rowcount FROM ({fx.SQL_ORDERS_CATALOG} UNION ALL {fx.SQL_LINEITEM_CATALOG})
WHERE key = 'o_orderdate'""",
)
def catalog_key_mismatch(spark, folder):
    both = fx.orders_catalog(spark, folder).unionByName(fx.lineitem_catalog(spark, folder))
    return catalog.with_key(both, "o_orderdate").select("name", "key", "rowcount")


def _selected(text):
    def run(spark, folder):
        return select.select_partitions(fx.orders_catalog(spark, folder), Selector.parse(text))

    return run


query("select_default", _CATALOG)(_selected(""))
query("select_each", f"SELECT * FROM ({_CATALOG}) WHERE name IN ('p199603', 'p199912', 'p200101')")(
    _selected("EACH(p199603, p199912, p200101)")
)
query("select_range", f"SELECT * FROM ({_CATALOG}) WHERE name >= 'p199605' AND name < 'p199902'")(
    _selected("RANGE(p199605, p199902)")
)
query("select_from", f"SELECT * FROM ({_CATALOG}) WHERE name >= 'p199911'")(_selected("STARTWITH(p199911)"))
query("select_until", f"SELECT * FROM ({_CATALOG}) WHERE name < 'p199604'")(_selected("ENDWITH(p199604)"))


@query(
    "select_multi_table",
    f"""
SELECT 'orders' AS "table", * FROM ({fx.SQL_ORDERS_CATALOG}) WHERE name IN ('p199601', 'p199602')
UNION ALL
SELECT 'lineitem', * FROM ({fx.SQL_LINEITEM_CATALOG}) WHERE name >= 'p200001'""",
)
def select_multi_table(spark, folder):
    both = fx.orders_catalog(spark, folder).withColumn("table", F.lit("orders")).unionByName(
        fx.lineitem_catalog(spark, folder).withColumn("table", F.lit("lineitem"))
    )
    chosen = split_selectors("EACH(p199601,p199602),STARTWITH(p200001)", ["orders", "lineitem"])
    return select.select_for_tables(both, chosen)


@query(
    "nonempty_partitions",
    f"""
SELECT name, count(*) AS rowcount FROM (SELECT {fx.SQL_MONTH.format('o_orderdate')} AS name FROM orders)
GROUP BY name""",
)
def nonempty_partitions(spark, folder):
    """Estimates that are zero although rows exist, and two, one of them large, for partitions that have no rows."""
    known = fx.orders_catalog(spark, folder)
    estimated = known.withColumn(
        "rowcount", F.when(F.month("start") % 2 == 0, F.lit(0)).otherwise(F.col("rowcount")).cast("bigint")
    )
    empty = known.where("name = 'p199501'").withColumns({"name": F.lit("p200201"), "rowcount": F.lit(5).cast("bigint")})
    large = empty.withColumns({"name": F.lit("p200202"), "rowcount": F.lit(5000).cast("bigint")})
    listed = saved(estimated.unionByName(empty).unionByName(large), "catalog")
    rows = fx.table(spark, folder, "orders").select(fx.ORDERS.partition_column().alias("pt"))
    return select.nonempty_partitions(listed, rows).select("name", "rowcount")


@query(
    "range_bounds_parse",
    f"""
SELECT name, key, regexp_extract_all(range, 'keys: \\[(.*?)\\];', 1)[1] AS start,
       regexp_extract_all(range, 'keys: \\[(.*?)\\];', 1)[2] AS "end"
FROM ({fx.SQL_TEXTS}) WHERE length(range) > 0""",
)
def range_bounds_parse(spark, folder):
    parsed = catalog.parsed_catalog(fx.catalog_texts(spark, folder))
    return parsed.where("ptype = 'range'").select("name", "key", "start", "end")


@query(
    "list_values_parse",
    f"""
SELECT name, key, trim(unnest(string_split(inner_text, ',')), ' "''') AS value
FROM (SELECT name, key, CASE WHEN list LIKE '((%' THEN list[3:-3] ELSE list[2:-2] END AS inner_text
      FROM ({fx.SQL_TEXTS}) WHERE length(list) > 0)""",
)
def list_values_parse(spark, folder):
    parsed = catalog.parsed_catalog(fx.catalog_texts(spark, folder))
    return parsed.where("ptype = 'list'").select("name", "key", F.explode("values").alias("value"))


@query(
    "bound_type",
    f"""
SELECT name, key, CASE WHEN instr(range, 'INT') > 1 THEN 'number' ELSE 'str' END AS dtype
FROM ({fx.SQL_TEXTS})""",
)
def bound_type(spark, folder):
    texts = fx.catalog_texts(spark, folder)
    return texts.select("name", "key", bounds.bound_type(F.coalesce("range", F.lit(""))).alias("dtype"))


def _sizes(spark, folder):
    """Size texts of the months: GB in even months, MB in odd ones, and one partition without rows."""
    months = fx.orders_catalog(spark, folder)
    unit = F.when(F.month("start") % 2 == 0, "GB").otherwise("MB")
    sizes = months.select("name", "rowcount", F.concat(F.col("rowcount").cast("string"), unit).alias("datasize"))
    empty = months.agg(F.max("name").alias("name")).select(
        F.concat("name", F.lit("x")).alias("name"), F.lit(0).cast("bigint").alias("rowcount"), F.lit("0B").alias("datasize")
    )
    return sizes.union(empty)


_SQL_SIZES = f"""
SELECT name, rowcount, rowcount || CASE WHEN month(start) % 2 = 0 THEN 'GB' ELSE 'MB' END AS datasize
FROM ({_CATALOG})
UNION ALL SELECT max(name) || 'x', CAST(0 AS BIGINT), '0B' FROM ({_CATALOG})"""
_SQL_BYTES = """
CASE WHEN datasize LIKE '%GB' THEN CAST(replace(datasize, 'GB', '') AS DOUBLE) * 1073741824
     WHEN datasize LIKE '%MB' THEN CAST(replace(datasize, 'MB', '') AS DOUBLE) * 1048576
     ELSE CAST(replace(datasize, 'B', '') AS DOUBLE) END"""
_SQL_GB = "CASE WHEN datasize LIKE '%GB' THEN CAST(replace(datasize, 'GB', '') AS DOUBLE) ELSE 0.0 END"


@query("size_text_parse", f"SELECT name, {_SQL_BYTES} AS bytes, CAST({_SQL_GB} AS DOUBLE) AS gb FROM ({_SQL_SIZES})")
def size_text_parse(spark, folder):
    return _sizes(spark, folder).select(
        "name",
        bounds.size_in_bytes(F.col("datasize")).alias("bytes"),
        bounds.gigabytes_only(F.col("datasize")).alias("gb"),
    )


@query(
    "partition_size_total",
    f"""
SELECT count(*) AS partitions, sum({_SQL_BYTES}) AS total_bytes, sum(CAST({_SQL_GB} AS DOUBLE)) AS gb_only
FROM ({_SQL_SIZES}) WHERE rowcount > 0""",
)
def partition_size_total(spark, folder):
    return catalog.total_size(_sizes(spark, folder))
