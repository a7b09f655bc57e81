"""Jobs over tables whose partitions are those of a catalog: ranges of any key, or lists of values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relocate.operators import intervals
from relocate.operators.assign import assign_lists
from relocate.operators.stage import CATALOG_FIELD
from relocate.session import few_values
from relocate.specs import Selector, TableSpec


def catalog_spec(name: str, metrics: dict | None = None, selector: Selector = Selector(), **settings) -> TableSpec:
    """Spec of a table that goes by the partitions of a catalog; its rows come from ``with_catalog``."""
    return TableSpec(name, partition=CATALOG_FIELD, metrics=metrics or {}, selector=selector, **settings)


def _kind(entries: DataFrame) -> tuple[list[str], str]:
    """Key columns and type of the partitions of one table's entries."""
    keys, kinds = few_values(entries, "key", 1), few_values(entries, "ptype", 1)
    if not keys or not kinds:
        raise ValueError("entries of one table, of one key and either ranges or lists")
    return [key.strip() for key in keys[0].split(",")], kinds[0]


def with_catalog(df: DataFrame, entries: DataFrame) -> DataFrame:
    """``df`` with each row's partition by the entries of a parsed catalog, for export and validation alike.

    Every row meets its partition in one job over all entries. Rows that no entry holds are ``unassigned``.
    """
    if CATALOG_FIELD in df.columns:
        raise ValueError(f"the table has a column {CATALOG_FIELD}")
    keys, kind = _kind(entries)
    if kind == "range":
        return intervals.assign_by_bounds(df, keys, entries.select("name", "start", "end"), CATALOG_FIELD)
    if len(keys) > 1:
        raise ValueError("list partitions of several columns")
    return assign_lists(df, keys[0], entries, CATALOG_FIELD)


def faults(df: DataFrame, entries: DataFrame) -> DataFrame:
    """What is wrong with the entries of a parsed catalog, read as the types of the table's key."""
    keys, kind = _kind(entries)
    kinds = [df.schema[key].dataType for key in keys]
    if kind == "range":
        return intervals.catalog_faults(entries, kinds)
    return intervals.list_faults(entries.select("name", F.col("values")), kinds[0])
