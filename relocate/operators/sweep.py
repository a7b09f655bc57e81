"""Running values over an order, without a task that sees all rows.

Rows are cut into ranges of the order. Each range works out its own running values; what it hands on to the next is one
row a range and group, and is added afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relocate.session import saved

PIECES = 64


def ranged(df: DataFrame, order: Sequence[str], label: str, pieces: int = PIECES) -> DataFrame:
    """``df`` saved in ranges of ``order``, with the number of its range in ``_piece``."""
    return saved(df.repartitionByRange(pieces, *order).withColumn("_piece", F.spark_partition_id()), label)


def numbered(df: DataFrame, order: Sequence[str], name: str, label: str) -> DataFrame:
    """``df`` with ``name``: 0 for its first row in ``order``, 1 for the next, and so on."""
    rows = ranged(df, order, label)
    earlier = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    begins = rows.groupBy("_piece").agg(F.count("*").alias("_n"))
    begins = begins.select("_piece", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_begin"))
    inside = F.row_number().over(Window.partitionBy("_piece").orderBy(*order)) - 1
    out = rows.join(F.broadcast(begins), "_piece").withColumn(name, F.col("_begin") + inside)
    return out.drop("_piece", "_begin")


def running_max(df: DataFrame, order: Sequence[str], value: Column, name: str, label: str) -> DataFrame:
    """``df`` with ``name``: the greatest ``value`` of the rows before in ``order``; NULL for the first."""
    rows = ranged(df.withColumn("_value", value), order, label)
    handed = rows.groupBy("_piece").agg(F.max("_value").alias("_most"))
    earlier = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    handed = handed.select("_piece", F.max("_most").over(earlier).alias("_handed"))
    inside = Window.partitionBy("_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(F.broadcast(handed), "_piece").withColumn(name, F.greatest("_handed", F.max("_value").over(inside)))
    return out.drop("_piece", "_value", "_handed")


def running_sum(df: DataFrame, order: Sequence[str], value: Column, name: str, label: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows before in ``order``; 0 for the first."""
    rows = ranged(df.withColumn("_value", value), order, label)
    earlier = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    handed = rows.groupBy("_piece").agg(F.sum("_value").alias("_all"))
    handed = handed.select("_piece", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_handed"))
    inside = Window.partitionBy("_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_handed") + F.coalesce(F.sum("_value").over(inside), F.lit(0))
    return rows.join(F.broadcast(handed), "_piece").withColumn(name, before).drop("_piece", "_value", "_handed")
