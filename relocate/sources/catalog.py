"""Partition catalogs: one row per partition with its bounds or values and its row count.

Range catalogs have ``name, key, ptype, start, end, rowcount``; list catalogs carry
``values`` in place of the bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relocate.functions import bounds, times


def calendar_catalog(df: DataFrame, key: str, unit: str = "month") -> DataFrame:
    """Range catalog of a table that is partitioned by day, month or year of ``key``.

    Reads the key column alone and aggregates before the shuffle. Rows without a key
    belong to no partition and are left out.
    """
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(times.period_start(F.col(key), unit).alias("start"))
        .agg(F.count("*").alias("rowcount"))
        .select(
            times.period_name(F.col("start"), unit).alias("name"),
            F.lit(key).alias("key"),
            F.lit("range").alias("ptype"),
            "start",
            times.period_end(F.col("start"), unit).alias("end"),
            "rowcount",
        )
    )


def numeric_catalog(df: DataFrame, key: str, width: int, origin: int = 0) -> DataFrame:
    """Range catalog of a table whose partitions are equal steps of an integer ``key``."""
    start = F.col(key) - F.pmod(F.col(key) - origin, F.lit(width))
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(start.cast("bigint").alias("start"))
        .agg(F.count("*").alias("rowcount"))
        .select(
            F.concat(F.lit("p"), F.col("start").cast("string")).alias("name"),
            F.lit(key).alias("key"),
            F.lit("range").alias("ptype"),
            "start",
            (F.col("start") + width).alias("end"),
            "rowcount",
        )
    )


def parsed_catalog(listing: DataFrame, compound: bool = False) -> DataFrame:
    """Catalog from a partition listing with texts.

    ``listing`` has ``name, key, rowcount`` and the texts ``range`` and ``list``, of which
    one is filled. Entries with neither are skipped. Bounds stay text; ``dtype`` says
    whether they are numbers. A key of several columns raises unless ``compound``.
    """
    text = F.coalesce(F.nullif(F.col("range"), F.lit("")), F.nullif(F.col("list"), F.lit("")))
    is_range = F.length(F.coalesce("range", F.lit(""))) > 0
    lower, upper = bounds.range_bounds(F.col("range"))
    unsupported = F.raise_error(F.concat(F.lit("partition key of several columns: "), "key"))
    return listing.where(text.isNotNull()).select(
        "name",
        F.col("key")
        if compound
        else F.when(F.contains("key", F.lit(",")), unsupported.cast("string")).otherwise(F.col("key")).alias("key"),
        F.when(is_range, "range").otherwise("list").alias("ptype"),
        bounds.bound_type(text).alias("dtype"),
        F.when(is_range, lower).alias("start"),
        F.when(is_range, upper).alias("end"),
        F.when(~is_range, bounds.list_values(F.col("list"))).alias("values"),
        F.col("rowcount").cast("bigint").alias("rowcount"),
    )


def with_key(catalog: DataFrame, key: str) -> DataFrame:
    """Catalog entries that are partitioned by ``key``; others cannot be moved by it."""
    return catalog.where(F.col("key") == key)


def total_size(sizes: DataFrame) -> DataFrame:
    """Size of all partitions that hold rows.

    ``total_bytes`` scales every unit; ``gb_only`` adds up the entries written in GB and nothing else.
    """
    return sizes.where(F.col("rowcount") > 0).agg(
        F.count("*").alias("partitions"),
        F.sum(bounds.size_in_bytes(F.col("datasize"))).alias("total_bytes"),
        F.sum(bounds.gigabytes_only(F.col("datasize"))).alias("gb_only"),
    )
