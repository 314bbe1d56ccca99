"""The feature table of the fare model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.functions.calendar import as_flag, is_rush_hour, is_weekend_day
from goldleaf.schemas import FEATURE_COLUMNS, LABEL

# Fares outside these bounds (both excluded) are outliers.
FARE_MIN = 0
FARE_MAX = 200


def is_valid_trip() -> Column:
    fare = F.col(LABEL)
    return (fare > FARE_MIN) & (fare < FARE_MAX) & (F.col("trip_distance") > 0)


def model_inputs() -> list[Column]:
    """The six model inputs, in order, from pickup time and distance."""
    pickup = F.col("tpep_pickup_datetime")
    weekday, hour = F.dayofweek(pickup), F.hour(pickup)
    by_name = {
        "trip_distance": F.col("trip_distance"),
        "pickup_hour": hour,
        "pickup_dayofweek": weekday,
        "pickup_month": F.month(pickup),
        "is_weekend": as_flag(is_weekend_day(weekday)),
        "is_rush_hour": as_flag(is_rush_hour(hour)),
    }
    return [by_name[name].alias(name) for name in FEATURE_COLUMNS]


def feature_table(trips: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Inputs and label of every valid trip, plus any source columns to carry along."""
    return trips.filter(is_valid_trip()).select(*keep, *model_inputs(), LABEL)


def without_null_inputs(features: DataFrame) -> DataFrame:
    return features.dropna(subset=list(FEATURE_COLUMNS))
