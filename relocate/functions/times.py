"""Times are wall-clock values (``timestamp_ntz``); none of these depends on the session zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: length of a status time, "yyyy-MM-dd HH:mm:ss".
STATUS_TIME_LENGTH = 19

# Part of "yyyy-MM-dd" that tells a calendar unit, and the digits in it. Partition names
# are "p" and those digits; their fixed width makes them sort as text.
DATE_LENGTH = {"day": 10, "month": 7, "year": 4}
NAME_DIGITS = {"day": 8, "month": 6, "year": 4}


def status_time(time: Column) -> Column:
    return F.left(time.cast("string"), F.lit(STATUS_TIME_LENGTH))


def first_day(time: Column, unit: str = "day") -> Column:
    """First day of the day, month or year, as a date."""
    day = F.to_date(time)
    return day if unit == "day" else F.trunc(day, unit)


def period_start(time: Column, unit: str = "day") -> Column:
    """First instant of the day, month or year."""
    return first_day(time, unit).cast("timestamp_ntz")


def period_end(start: Column, unit: str = "day") -> Column:
    """First instant after the day, month or year that begins at ``start``."""
    day = F.to_date(start)
    following = F.date_add(day, 1) if unit == "day" else F.add_months(day, {"month": 1, "year": 12}[unit])
    return following.cast("timestamp_ntz")


def period_name(time: Column, unit: str = "day") -> Column:
    digits = F.left(F.to_date(time).cast("string"), F.lit(DATE_LENGTH[unit]))
    return F.concat(F.lit("p"), F.replace(digits, F.lit("-"), F.lit("")))


def with_default_time(time: Column, loaded_at: Column | None = None) -> Column:
    """A missing insert time becomes the load time."""
    return F.coalesce(time, F.localtimestamp() if loaded_at is None else loaded_at)


def named_period(name: str, unit: str) -> tuple[str, str] | None:
    """Start and end of the period a partition name stands for; None for any other text."""
    digits = name[1:]
    if not name.startswith("p") or len(digits) != NAME_DIGITS[unit] or not digits.isdigit():
        return None
    try:
        start = dt.date(int(digits[:4]), int(digits[4:6] or 1), int(digits[6:8] or 1))
        if unit == "day":
            end = start + dt.timedelta(days=1)
        elif unit == "month":
            end = (start + dt.timedelta(days=31)).replace(day=1)
        else:
            end = start.replace(year=start.year + 1)
    except (ValueError, OverflowError):
        return None
    return f"{start} 00:00:00", f"{end} 00:00:00"
