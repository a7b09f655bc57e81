"""Rows to partitions, for tables whose catalog is not a calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.operators.intervals import assign_by_bounds
from relocate.session import broadcast_below
from relocate.specs import UNASSIGNED

# Largest catalog that is sent to every executor; beyond it the join shuffles and AQE splits hot keys.
BROADCAST_ROWS = 100_000

# Level of ranges without a start or an end.
OPEN = -1


def _position(value: Column, kind: T.DataType) -> Column:
    """A bound or key as a whole number in the same order: itself, days, or seconds since 1970."""
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(value)
    if isinstance(kind, T.TimestampNTZType):
        # from its fields, as no session zone has a part in it
        clock = F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
        return F.unix_date(F.to_date(value)).cast("bigint") * 86400 + clock
    raise TypeError(f"range partitions need an integer, date or time key, not {kind.simpleString()}")


def listed_ranges(bounds: DataFrame, kind: T.DataType) -> DataFrame:
    """Ranges ``_name, _start, _end`` under the buckets they touch: ``_level`` and ``_bucket``.

    The buckets of a level are ``2 ** level`` wide. A range is listed in the level whose buckets are as wide as itself
    or up to twice as wide, so it touches at most three, and a bucket holds few ranges, however uneven they are.
    Reversed and empty ranges hold nothing and are left out; ranges with an open end are listed at level ``OPEN``.
    """
    low, high = _position(F.col("_start"), kind), _position(F.col("_end"), kind)
    span = F.try_subtract(high, low)
    is_open = F.col("_start").isNull() | F.col("_end").isNull()
    level = F.when(is_open, OPEN).when(span <= 1, 0).otherwise(F.coalesce(F.ceil(F.log2(span)), F.lit(63))).cast("int")
    bounds = bounds.where(is_open | (F.col("_start") < F.col("_end")))
    levelled = bounds.withColumns({"_level": level, "_low": low, "_high": high})
    touched = F.expr(f"IF(_level = {OPEN}, array(0L), sequence(shiftright(_low, _level), shiftright(_high, _level)))")
    return levelled.withColumn("_bucket", F.explode(touched)).select("_name", "_start", "_end", "_level", "_bucket")


def assign_ranges(df: DataFrame, key: str, catalog: DataFrame, name: str = "pt") -> DataFrame:
    """Add the name of the range partition ``start <= key < end`` that holds each row.

    Ranges must not overlap. Every range is listed under buckets of about its own width, so
    the match is one equality join for each width that occurs, with the bounds as further
    condition; no row is compared with more than a few ranges. Widths are powers of two:
    catalogs of even ranges have one or two, and none has more than 64. Rows outside every
    range, or without a key, are named ``unassigned``; reversed and empty ranges hold none. A
    catalog with an open end, a NULL bound, is left to ``intervals.assign_by_bounds``, which also
    takes keys of other types; here they raise.
    """
    kind = df.schema[key].dataType
    bounds = catalog.select(
        F.col("name").alias("_name"), F.col("start").cast(kind).alias("_start"), F.col("end").cast(kind).alias("_end")
    )
    listed = listed_ranges(bounds, kind)
    sizes = sorted(tuple(row) for row in listed.groupBy("_level").agg(F.count("*")).collect())
    if any(level == OPEN for level, _ in sizes):
        return assign_by_bounds(df, [key], catalog, name)
    found, out = [], df
    for level, entries in sizes:
        own = listed.where(F.col("_level") == level).select(
            F.col("_name").alias(f"_name_{level}"),
            F.col("_start").alias(f"_start_{level}"),
            F.col("_end").alias(f"_end_{level}"),
            F.col("_bucket").alias(f"_bucket_{level}"),
        )
        matches = (
            (F.shiftright(_position(F.col(key), kind), level) == F.col(f"_bucket_{level}"))
            & (F.col(key) >= F.col(f"_start_{level}"))
            & (F.col(key) < F.col(f"_end_{level}"))
        )
        out = out.join(broadcast_below(own, entries, BROADCAST_ROWS), matches, "left")
        found.append(F.col(f"_name_{level}"))
    return out.select(*[F.col(column) for column in df.columns], F.coalesce(*found, F.lit(UNASSIGNED)).alias(name))


def assign_lists(df: DataFrame, key: str, catalog: DataFrame, name: str = "pt") -> DataFrame:
    """Add the name of the list partition whose values hold each row's key, else ``unassigned``."""
    kind = df.schema[key].dataType
    listed = catalog.select(F.col("name").alias("_name"), F.explode("values").alias("_value"))
    listed = listed.withColumn("_value", F.col("_value").cast(kind))
    listed = broadcast_below(listed, listed.count(), BROADCAST_ROWS)
    return df.join(listed, F.col(key) == F.col("_value"), "left").select(
        *[F.col(column) for column in df.columns], F.coalesce("_name", F.lit(UNASSIGNED)).alias(name)
    )
