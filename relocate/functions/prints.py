"""Sums of 64-bit prints without overflow and without decimals: three parts of a print are added apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bits of a part: sums of up to 2 ** 41 rows fit 64 bits.
PART_BITS = 22

_SHIFTS = (0, PART_BITS, 2 * PART_BITS)


def limbs() -> int:
    return len(_SHIFTS)


def limb_sums(value: Column, weight: Column) -> list[Column]:
    """Sum of ``weight * value`` for a 64-bit value, as one sum for each part; NULL values are left out.

    With weights of 1 and -1 all parts are 0 where both sides have the same values, in whatever order.
    """
    mask = F.lit((1 << PART_BITS) - 1).cast("bigint")
    parts = [F.shiftrightunsigned(value, shift).bitwiseAND(mask) for shift in _SHIFTS]
    return [F.sum(part * weight) for part in parts]


def joined_sum(parts: list[Column]) -> Column:
    """The whole sum from the sums of its parts; NULL where all are."""
    exact = T.DecimalType(38, 0)
    return sum(
        (part.cast(exact) * F.lit(str(1 << shift)).cast(T.DecimalType(20, 0)) for part, shift in zip(parts[1:], _SHIFTS[1:])),
        parts[0].cast(exact),
    ).cast(exact)
