"""Partition predicates on the key column, typed so that they reach the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relocate.specs import as_column, typed_literal


def range_predicate(df: DataFrame, key: str, start: object, end: object) -> Column:
    """``start <= key < end`` with the bounds in the key's own type; a bad bound raises."""
    kind = df.schema[key].dataType
    column = F.col(key)
    return (column >= typed_literal(start, kind)) & (column < typed_literal(end, kind))


def list_predicate(df: DataFrame, key: str, values: list) -> Column:
    kind = df.schema[key].dataType
    typed = [typed_literal(value, kind) for value in values]
    return F.col(key) == typed[0] if len(typed) == 1 else F.col(key).isin(*typed)


def partition_rows(
    df: DataFrame,
    key: str,
    start: object = None,
    end: object = None,
    values: list | None = None,
    row_filter: str | Column | None = None,
) -> DataFrame:
    """Rows of one partition. The row filter is a condition of its own, so an OR in it stays inside."""
    wanted = range_predicate(df, key, start, end) if values is None else list_predicate(df, key, values)
    df = df.where(wanted)
    return df if row_filter is None else df.where(as_column(row_filter))


def within_bounds(df: DataFrame, key: str, catalog: DataFrame) -> DataFrame:
    """Rows between the lowest and the highest bound of ``catalog``.

    A pre-filter that prunes the scan; exact membership is left to the assignment. One row
    of the catalog's aggregate comes to the driver.
    """
    low, high = catalog.agg(F.min("start").cast("string"), F.max("end").cast("string")).first()
    if low is None:
        return df.where(F.lit(False))
    return df.where(range_predicate(df, key, low, high))
