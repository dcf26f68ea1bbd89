"""Date-part and duration expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def weekday(c: str | Column, week_start: str = "sunday") -> Column:
    """Day of week, 0-based: Sunday=0 (``"sunday"``) or Monday=0 (``"monday"``).

    Spark's ``dayofweek`` is 1 (Sunday) .. 7 and ``weekday`` is 0 (Monday) .. 6.
    """
    col = F.col(c) if isinstance(c, str) else c
    if week_start == "sunday":
        return F.dayofweek(col) - 1
    if week_start == "monday":
        return F.weekday(col)
    raise ValueError(f"week_start must be 'sunday' or 'monday', not {week_start!r}")


def datetime_parts(c: str, prefix: str, week_start: str = "sunday") -> list[Column]:
    """hour, day, month, year and weekday of timestamp column ``c``, as ints."""
    col = F.col(c)
    return [
        F.hour(col).alias(f"{prefix}_hour"),
        F.dayofmonth(col).alias(f"{prefix}_day"),
        F.month(col).alias(f"{prefix}_month"),
        F.year(col).alias(f"{prefix}_year"),
        weekday(col, week_start).cast("int").alias(f"{prefix}_weekday"),
    ]


def duration_seconds(start: str, end: str, unit: str = "int") -> Column:
    """``end - start`` in seconds.

    ``unit="double"`` keeps the fraction; ``unit="int"`` rounds half-even to a
    whole second, as storing the value into an INTEGER column does.
    """
    secs = F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)) / F.lit(1_000_000.0)
    if unit == "double":
        return secs
    if unit == "int":
        return F.bround(secs, 0).cast("int")
    raise ValueError(f"unit must be 'int' or 'double', not {unit!r}")
