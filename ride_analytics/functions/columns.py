"""Column expressions shared by the jobs. All of them run inside Spark's codegen."""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
# Smallest denominator of a percentage error: the spacing of doubles at 1.0.
TINY = 2.220446049250313e-16


def hour_of(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def is_weekend(dow: Column) -> Column:
    return dow.isin(5, 6).cast("int")


def is_night(hour: Column) -> Column:
    """From 20:00 until before 06:00."""
    return ((hour >= 20) | (hour < 6)).cast("int")


def is_rush(hour: Column, dow: Column) -> Column:
    """From 16:00 until before 20:00, Monday to Friday."""
    return ((hour >= 16) & (hour < 20) & (dow < 5)).cast("int")


def duration_minutes(start: str, end: str) -> Column:
    """Keeps fractions of a second, which ``unix_timestamp`` would drop."""
    return F.expr(f"timestampdiff(MICROSECOND, `{start}`, `{end}`)") / F.lit(6.0e7)


def duration_hours(start: str, end: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, `{start}`, `{end}`)") / F.lit(3.6e9)


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Null stays null; ``least`` and ``greatest`` alone would skip it."""
    out = c
    if low is not None:
        out = F.when(out < low, F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(out > high, F.lit(high)).otherwise(out)
    return out


def speed_mph(distance: Column, hours: Column, cap: float = 100.0) -> Column:
    """Null for a zero duration; a negative duration keeps its negative speed."""
    return clip(F.when(hours != 0, distance / hours), high=cap)


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, denominator)


def cyclic(c: Column, period: float) -> tuple[Column, Column]:
    angle = c * F.lit(2.0 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def residual(actual: str, predicted: str) -> Column:
    """Actual minus predicted, everywhere in this package."""
    return F.col(actual) - F.col(predicted)


def absolute_error(actual: str, predicted: str) -> Column:
    return F.abs(residual(actual, predicted))


def percentage_error(actual: str, predicted: str) -> Column:
    return absolute_error(actual, predicted) / F.greatest(F.abs(F.col(actual)), F.lit(TINY))


def weekday_name(dow: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), dow.cast("int") + 1)


def day_type(weekend_flag: Column) -> Column:
    return F.when(weekend_flag == 1, "Weekend").when(weekend_flag == 0, "Weekday")


def display_name(column: str) -> str:
    return column.replace("_", " ")


def view_cap(largest: Column, step: int = 5, ceiling: float = 100.0) -> Column:
    """Axis limit: the next multiple of ``step``, at most ``ceiling``."""
    return F.least(F.lit(float(ceiling)), F.ceil(largest / step).cast("double") * step)


def all_of(conditions) -> Column:
    return reduce(and_, conditions)
