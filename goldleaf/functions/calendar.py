"""Columns read off a timestamp."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sunday and Saturday as Spark counts weekdays, and both rush hours (inclusive).
WEEKEND_DAYS = (1, 7)
RUSH_HOURS = ((7, 9), (16, 19))


def is_weekend_day(day_of_week: Column) -> Column:
    """True on Saturday and Sunday; an unknown day is not a weekend."""
    return F.coalesce(day_of_week.isin(*WEEKEND_DAYS), F.lit(False))


def is_rush_hour(hour: Column) -> Column:
    """True inside either rush hour; an unknown hour is not one."""
    inside = reduce(or_, (hour.between(first, last) for first, last in RUSH_HOURS))
    return F.coalesce(inside, F.lit(False))


def as_flag(condition: Column) -> Column:
    """The 0/1 form a model takes."""
    return condition.cast("int")
