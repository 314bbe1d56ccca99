"""Sketches per group: exact parts, errors of the estimates, merging, edge cases, and windows kept up by the monitoring job."""

import random
import uuid
from datetime import date, timedelta

from pyspark.sql import functions as F

from goldleaf.operators import sketches as sk
from goldleaf.plans import fare_jobs, monitoring, monitoring_days, monitoring_windows, trip_features
from goldleaf.session import run_folder
from goldleaf.sources import sample_tables as sample

SMALL = "/root/testdata/sf0.001"
HALVES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
START = date(2024, 1, 1)


def by_hand(values):
    """Rows, nulls, least, greatest and the sorted numbers of a column."""
    known = [value for value in values if value is not None]
    return len(values), len(values) - len(known), min(known, default=None), max(known, default=None), sorted(known)


def test_windows_against_all_rows(spark):
    """One value holds a third of the rows, one model has days without rows, one column is null throughout."""
    draw = random.Random(3)
    days = [day for day in range(40) if day % 9 != 4]
    rows = [
        ("a" if draw.random() < 0.8 else "b", START + timedelta(days=draw.choice(days)),
         5.0 if draw.random() < 0.33 else draw.choice([None, draw.gauss(0, 100), float(draw.randrange(30))]), None)
        for _ in range(60_000)
    ]
    df = spark.createDataFrame(rows, "model_id string, day date, x double, empty double")
    daily = sk.day_sketches(df, ["day", "model_id"], ["x", "empty"])
    ends = spark.createDataFrame([("a", START + timedelta(days=39)), ("b", START + timedelta(days=13))], "model_id string, day date")
    found = sk.read_out(sk.over_windows(daily, ends, "day", ["model_id"], [7, 30]), HALVES).collect()
    assert len(found) == 8
    for row in found:
        first = row.window_end - timedelta(days=row.window_days - 1)
        inside = [r[2 if row.column_name == "x" else 3] for r in rows if r[0] == row.model_id and first <= r[1] <= row.window_end]
        n, nulls, least, greatest, numbers = by_hand(inside)
        assert (row.rows, row.nulls, row.min, row.max) == (n, nulls, least, greatest)
        if not numbers:
            assert (row.mean, row.distinct_values, row.p25, row.p50, row.p75) == (None, 0, None, None, None)
            continue
        assert abs(row.mean - sum(numbers) / len(numbers)) < 1e-6
        assert abs(row.distinct_values - len(set(numbers))) <= sk.DISTINCT_ERROR * len(set(numbers))
        for name, share in HALVES.items():
            assert sum(v < row[name] for v in numbers) <= (share + sk.RANK_ERROR) * len(numbers) + 1
            assert sum(v <= row[name] for v in numbers) >= (share - sk.RANK_ERROR) * len(numbers) - 1


def test_merging_does_not_hang_on_the_parts(spark):
    df = spark.range(20_000).select((F.col("id") % 7).alias("g"), (F.col("id") * 3 % 4001).cast("double").alias("x"))
    parts = sk.day_sketches(df, ["g"], ["x"])
    whole = sk.day_sketches(df.select(F.lit(1).alias("g"), "x"), ["g"], ["x"])
    one, other = (sk.read_out(sk.merged(s, ["column_name"]), {}).first() for s in (parts, whole))
    assert (one.rows, one.nulls, one.min, one.max, one.mean) == (other.rows, other.nulls, other.min, other.max, other.mean)
    assert abs(one.distinct_values - 4001) < 0.05 * 4001 and abs(other.distinct_values - 4001) < 0.05 * 4001


def test_nan_zero_null_groups_and_empty_tables(spark):
    rows = [(None, 0.0), (None, -0.0), (None, float("nan")), (None, None), (1, None)]
    df = spark.createDataFrame(rows, "g int, x double")
    found = {r.g: r for r in sk.read_out(sk.day_sketches(df, ["g"], ["x"]), {"p50": 0.5}).collect()}
    unnamed, nothing = found[None], found[1]
    assert (unnamed.rows, unnamed.nulls, unnamed.distinct_values, unnamed.min, unnamed.max, unnamed.p50) == (4, 1, 2, 0.0, 0.0, 0.0)
    assert (nothing.rows, nothing.nulls, nothing.distinct_values, nothing.mean, nothing.p50) == (1, 1, 0, None, None)
    assert sk.day_sketches(df.limit(0), ["g"], ["x"]).count() == 0


def test_monitoring_keeps_sketches_of_touched_days(spark):
    """After a late day the windows equal those of all predictions, and reading them reads sketches alone."""
    place = fare_jobs.Place(spark, f"t_{uuid.uuid4().hex[:10]}", run_folder(spark, "test"))
    log, features = sample.payload_log(spark, SMALL), trip_features.feature_table(sample.trips(spark, SMALL))
    for known in (log.where(F.dayofmonth("request_time") % 6 != 0), log):
        monitoring_days.refresh_days(place, known, features, F.col("request_id"))
    kept = place.read(monitoring_days.SKETCHES)
    profiles = monitoring_windows.window_profiles(kept)
    files = profiles.inputFiles()
    assert files and all(monitoring_days.SKETCHES in file for file in files)
    fresh = monitoring_windows.window_profiles(monitoring_windows.daily_sketches(place.read("inferences")))
    exact = ["window_end", "window_days", "model_id", "column_name", "rows", "nulls", "min", "max"]
    assert profiles.count() == fresh.count() > 0 and profiles.select(exact).exceptAll(fresh.select(exact)).count() == 0
    checked = monitoring_windows.within_error(profiles, place.read(monitoring_days.COUNTS))
    assert checked.count() == profiles.count() and checked.where("NOT distinct_close OR NOT quartiles_close").count() == 0
    assert monitoring.profiles(place.read("inferences")).count() == kept.count()
