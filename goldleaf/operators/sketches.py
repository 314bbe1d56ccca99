"""Distributions of columns per group as sketches that can be merged, for windows over groups already summed up.

A group's column becomes one row of a few kilobytes, whatever the group's size: exact counts, extremes and sum, a
HyperLogLog sketch of its different values and a KLL sketch of their order. Rows of several groups merge into the row of
their union, so a window is summed up without its rows being read again. Both sketches are aggregated on the map side
first, so a group that holds a third of the rows moves as one row per task.

Null values are counted and in no sketch. A NaN counts as a value among the different ones, and is left out of extremes, mean and
quantiles. ``-0.0`` is ``0.0``. An empty table has no groups; a group of nulls has null extremes, mean and quantiles and 0 different values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.operators.distribution import COLUMN, VALUE

# 2 ** 12 registers: a merged estimate has a relative standard error of 1.04 / sqrt(4096) = 1.6 %.
DISTINCT_BITS = 12
DISTINCT_ERROR = 0.05
# Retained items per level: at 99 % confidence a rank is off by about 0.7 % of the rows.
ORDER_SIZE = 400
RANK_ERROR = 0.0133

SUMMED = ("rows", "nulls", "numbers", "total")


def day_sketches(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``by``, column name, rows, nulls, numbers, total, min, max, ``values_seen`` and ``value_order`` (sketches)."""
    # adding zero makes one value of both zeros
    numbers = df.select(*by, *((F.col(name).cast("double") + F.lit(0.0)).alias(name) for name in columns))
    long = numbers.unpivot(list(by), list(columns), COLUMN, VALUE)
    value = F.col(VALUE)
    number = F.when(~F.isnan(value), value)
    return long.groupBy(*by, COLUMN).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(value.isNull()).alias("nulls"),
        F.count(number).alias("numbers"),
        F.sum(number).alias("total"),
        F.min(number).alias("min"),
        F.max(number).alias("max"),
        F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value)), F.lit(DISTINCT_BITS)).alias("values_seen"),
        F.kll_sketch_agg_double(number, F.lit(ORDER_SIZE)).alias("value_order"),
    )


def merged(sketches: DataFrame, group: Sequence[str]) -> DataFrame:
    """The sketches of the union of all groups that agree in ``group``."""
    return sketches.groupBy(*group).agg(
        *(F.sum(name).alias(name) for name in SUMMED),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.hll_union_agg("values_seen").alias("values_seen"),
        F.kll_merge_agg_double("value_order").alias("value_order"),
    )


def read_out(sketches: DataFrame, shares: Mapping[str, float]) -> DataFrame:
    """Figures in place of sketches: different values and quantiles are estimates, all others exact."""

    def at(share: float) -> Column:
        return F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double("value_order", F.lit(share)))

    known = [name for name in sketches.columns if name not in (*SUMMED, "min", "max", "values_seen", "value_order")]
    return sketches.select(
        *known, "rows", "nulls", "min", "max",
        F.try_divide(F.col("total"), F.col("numbers")).alias("mean"),
        F.hll_sketch_estimate("values_seen").alias("distinct_values"),
        *(at(share).alias(name) for name, share in shares.items()),
    )


def over_windows(sketches: DataFrame, ends: DataFrame, day: str, by: Sequence[str], lengths: Sequence[int]) -> DataFrame:
    """Merged sketches of the ``lengths`` days up to and including each end.

    ``ends`` has ``by`` and ``day``, a row per window end. Windows are spelled out as keys only, and each day's
    sketches then meet the windows they are in. Days without sketches add nothing; a window without any has no row.
    """
    spelled = ends.select(*by, F.col(day).alias("window_end")).distinct().withColumn(
        "window_days", F.explode(F.array(*(F.lit(length) for length in lengths)))
    )
    members = spelled.withColumn(day, F.explode(F.sequence(F.expr("date_sub(window_end, window_days - 1)"), F.col("window_end"))))
    in_windows = sketches.join(members, [*by, day])
    return merged(in_windows, ["window_end", "window_days", *by, COLUMN])
