"""Choice of partitions from a catalog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relocate.specs import Selector


def select_partitions(catalog: DataFrame, selector: Selector) -> DataFrame:
    """Catalog rows that a selector keeps. A selector that matches nothing gives no rows."""
    if selector.whole_table:
        raise ValueError("ALL reads the whole table and selects no partitions")
    return catalog.where(selector.keeps("name"))


def select_for_tables(catalog: DataFrame, selectors: Mapping[str, Selector]) -> DataFrame:
    """Selection over a catalog of several tables, each with its own selector.

    Tables without a selector keep all partitions; tables read whole (``ALL``) keep none.
    """
    kept = ~F.col("table").isin(*selectors) if selectors else F.lit(True)
    for table, selector in selectors.items():
        if not selector.whole_table:
            kept = kept | ((F.col("table") == table) & selector.keeps("name"))
    return catalog.where(kept)


def sorted_catalog(catalog: DataFrame) -> DataFrame:
    return catalog.orderBy("name")


def nonempty_partitions(
    catalog: DataFrame, rows: DataFrame, partition: str = "pt", trusted: int | None = None
) -> DataFrame:
    """Catalog entries that hold rows, with their exact count.

    All partitions are counted in one job over the partition column alone. With ``trusted``,
    counts of the catalog from there up are taken as they are, and the scan is limited to the
    other partitions where ``partition`` is a partition folder.
    """
    relied_on = F.lit(False) if trusted is None else F.col("rowcount") >= trusted
    doubtful = catalog.where(~relied_on).select(F.col("name").alias("_name"))
    exact = (
        rows.join(doubtful, F.col(partition) == F.col("_name"), "left_semi")
        .groupBy(F.col(partition).alias("name"))
        .agg(F.count("*").alias("_exact"))
    )
    count = F.when(relied_on, F.col("rowcount")).otherwise(F.coalesce("_exact", F.lit(0).cast("bigint")))
    return catalog.join(exact, "name", "left").withColumn("rowcount", count).drop("_exact").where("rowcount > 0")
