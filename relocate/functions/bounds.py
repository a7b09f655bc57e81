"""Texts of a partition listing: range bounds, list values, bound types and sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The wording around a bound and the mark of an integer bound.
BOUND_PATTERN = r"keys: \[(.*?)\];"
INTEGER_MARK = "INT"

# Bytes per size unit.
SIZE_UNITS = {"B": 1, "KB": 1 << 10, "MB": 1 << 20, "GB": 1 << 30, "TB": 1 << 40, "PB": 1 << 50}


def range_bounds(text: Column) -> tuple[Column, Column]:
    """Lower and upper bound of a range text, NULL where a bound is missing."""
    found = F.regexp_extract_all(text, F.lit(BOUND_PATTERN), F.lit(1))
    return F.get(found, F.lit(0)), F.get(found, F.lit(1))


def list_values(text: Column) -> Column:
    """Values of a list text: ``((a, b))``, or any text with one enclosing character at each end.

    Blanks and quotes around a value are dropped.
    """
    inner = F.when(
        text.startswith("(("), F.regexp_extract(text, r"^\(\((.*?)\)\)", 1)
    ).otherwise(F.substring(text, F.lit(2), F.length(text) - 2))
    return F.transform(F.split(inner, ","), lambda item: F.regexp_replace(item, r"""^[\s"']+|[\s"']+$""", ""))


def bound_type(text: Column) -> Column:
    """``number`` for integer bounds, else ``str``."""
    return F.when(F.instr(text, INTEGER_MARK) > 1, "number").otherwise("str")


def size_in_bytes(text: Column) -> Column:
    """``12.5GB`` as a number of bytes; NULL for a text that is no size."""
    amount = F.regexp_extract(text, r"^\s*([0-9.]+)\s*([A-Za-z]+)\s*$", 1)
    unit = F.upper(F.regexp_extract(text, r"^\s*([0-9.]+)\s*([A-Za-z]+)\s*$", 2))
    factor = F.lit(None).cast("bigint")
    for name, size in SIZE_UNITS.items():
        factor = F.when(unit == name, F.lit(size)).otherwise(factor)
    return amount.try_cast("double") * factor


def gigabytes_only(text: Column) -> Column:
    """The number in front of ``GB``; 0 for every other unit."""
    return F.when(
        text.endswith("GB"), F.regexp_replace(text, "GB", "").try_cast("double")
    ).otherwise(F.lit(0.0))
