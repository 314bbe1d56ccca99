"""Ratios that stay defined under ANSI arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, null when there is nothing to divide by."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percentage(part: Column, whole: Column, places: int = 2) -> Column:
    return F.round(ratio(part, whole) * 100, places)


def rate_over_days(events: Column, days: Column) -> Column:
    """Events per day; zero when the span is empty, negative or unknown."""
    return F.when(days > 0, ratio(events, days)).otherwise(F.lit(0.0))
