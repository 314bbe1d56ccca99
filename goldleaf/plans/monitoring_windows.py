"""Profiles over several days of the inference log, merged from a stored row of sketches per day, model and column.

``refresh_days`` keeps these rows in ``profile_sketches``, a partition per day. Windows read that table alone: neither the log nor
its value counts, and of the partitions only those the windows cover. Predictions without a day are in the row of the null day and in no window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.operators import sketches as sk
from goldleaf.operators.distribution import COLUMN, ROWS, VALUE
from goldleaf.plans.monitoring import PREDICTION
from goldleaf.schemas import FEATURE_COLUMNS

DAY, MODEL = "day", "model_id"
LENGTHS = (7, 30)
QUARTERS = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def daily_sketches(predictions: DataFrame, columns: Sequence[str] = (*FEATURE_COLUMNS, PREDICTION)) -> DataFrame:
    return sk.day_sketches(predictions.withColumn(DAY, F.to_date("timestamp")), [DAY, MODEL], columns)


def every_day(sketches: DataFrame) -> DataFrame:
    """Each model's days."""
    return sketches.where(F.col(DAY).isNotNull()).select(MODEL, DAY).distinct()


def last_days_of_weeks(sketches: DataFrame) -> DataFrame:
    """Each model's last day of every week, Monday to Sunday."""
    return every_day(sketches).groupBy(MODEL, F.trunc(DAY, "week").alias("_week")).agg(F.max(DAY).alias(DAY)).drop("_week")


def window_profiles(sketches: DataFrame, ends: DataFrame | None = None, lengths: Sequence[int] = LENGTHS) -> DataFrame:
    """Profiles of the days up to and including each end; without ``ends``, for every day of each model.

    Rows, nulls, extremes and mean are exact. Different values are estimated with a relative standard error of 1.6 %,
    quartiles are values whose rank is within ``RANK_ERROR`` of the share asked for.
    """
    ends = every_day(sketches) if ends is None else ends
    return sk.read_out(sk.over_windows(sketches, ends, DAY, [MODEL], lengths), QUARTERS)


def within_error(profiles: DataFrame, counts: DataFrame) -> DataFrame:
    """The profiles with ``distinct_close`` and ``quartiles_close``: whether estimates are within the stated errors of the
    exact figures, taken from the value counts of the same days.

    Each day's counts meet the windows they are in and become one row per window and value; values are then compared with
    the window's estimates, so no running total is needed.
    """
    keys = ["window_end", "window_days", MODEL, COLUMN]
    members = profiles.select(*keys).withColumn(
        DAY, F.explode(F.sequence(F.expr("date_sub(window_end, window_days - 1)"), F.col("window_end")))
    )
    by_value = (
        counts.where(F.col(VALUE).isNotNull()).join(members, [DAY, MODEL, COLUMN])
        .groupBy(*keys, VALUE).agg(F.sum(ROWS).alias(ROWS))
    )
    number = ~F.isnan(VALUE)

    def ranks(name: str) -> list[Column]:
        below = F.sum(F.when(number & (F.col(VALUE) < F.col(name)), F.col(ROWS)).otherwise(0))
        up_to = F.sum(F.when(number & (F.col(VALUE) <= F.col(name)), F.col(ROWS)).otherwise(0))
        return [below.alias(f"below_{name}"), up_to.alias(f"up_to_{name}")]

    exact = by_value.join(profiles.select(*keys, *QUARTERS), keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("exact_distinct"),
        F.sum(F.when(number, F.col(ROWS)).otherwise(0)).alias("numbers"),
        *(rank for name in QUARTERS for rank in ranks(name)),
    )
    close = F.lit(True)
    for name, share in QUARTERS.items():
        close &= F.col(f"below_{name}") <= F.ceil(F.col("numbers") * (share + sk.RANK_ERROR))
        close &= F.col(f"up_to_{name}") >= F.floor(F.col("numbers") * (share - sk.RANK_ERROR))
    off = F.abs(F.col("distinct_values") - F.coalesce("exact_distinct", F.lit(0)))
    return profiles.join(exact, keys, "left").select(
        *profiles.columns,
        (off <= F.greatest(F.lit(1), sk.DISTINCT_ERROR * F.col("exact_distinct"))).alias("distinct_close"),
        F.coalesce(close, F.lit(True)).alias("quartiles_close"),
    )
