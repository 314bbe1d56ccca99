import math
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldleaf.operators import distribution as dist
from goldleaf.plans import monitoring
from tests.test_payloads import KNOWN, PREDICTED


@pytest.fixture(scope="module")
def calls():
    """Four days of two models; one distance holds a third of the rows and a day is missing."""
    draw = random.Random(11)
    found = []
    for k in range(1200):
        day = draw.choice([1, 2, 4, 5])
        model = "a" if draw.random() < 0.7 else "b"
        if model == "b" and day == 2:
            continue
        distance = 3.25 if draw.random() < 0.34 else draw.randrange(1, 80 + 5 * day) / 4
        hour = draw.randrange(24)
        at = datetime(2024, 1, day, hour) + timedelta(minutes=draw.randrange(60))
        fare = None if draw.random() < 0.02 else 3 + 2.5 * distance
        found.append((at, at.date(), model, distance, hour, 1 + day % 7, 1, day % 2, hour % 2, fare, str(k)))
    return found


@pytest.fixture(scope="module")
def predictions(spark, calls):
    return spark.createDataFrame(calls, PREDICTED).repartition(4)


@pytest.fixture(scope="module")
def trips(calls):
    draw = random.Random(12)
    return [(*c[3:9], draw.randrange(8, 1500) / 8) for c in calls for _ in range(draw.randrange(3))]


def per_day(calls, place):
    values = defaultdict(list)
    for c in calls:
        if c[place] is not None:
            values[c[1], c[2]].append(c[place])
    return values


def days_before(values):
    """(day, model) with the model's previous day, where there is one."""
    for day, model in values:
        earlier = [d for d, m in values if m == model and d < day]
        if earlier:
            yield (day, model), (max(earlier), model)


def test_volume(predictions, calls):
    found = {(r.day, r.model_id): r.inferences for r in monitoring.volume(predictions).collect()}
    assert found == Counter((c[1], c[2]) for c in calls)


def test_quality_equals_every_pair_written_out(spark, predictions, calls, trips):
    fares = defaultdict(list)
    for trip in trips:
        fares[trip[:6]].append(trip[6])
    pairs = defaultdict(list)
    for c in calls:
        if c[9] is not None:
            pairs[c[1], c[2]] += [(c[9], fare) for fare in fares[c[3:9]]]
    found = monitoring.quality(predictions, spark.createDataFrame(trips, KNOWN)).collect()
    assert {(r.day, r.model_id) for r in found} == {key for key, value in pairs.items() if value}
    for r in found:
        guess, truth = np.array(pairs[r.day, r.model_id]).T
        error = guess - truth
        assert r.labeled == len(error)
        assert r.mae == pytest.approx(np.abs(error).mean())
        assert r.mse == pytest.approx((error**2).mean())
        assert r.rmse == pytest.approx(math.sqrt((error**2).mean()))
        assert r.mape == pytest.approx((np.abs(error) / truth).mean())
        assert r.r2 == pytest.approx(1 - (error**2).sum() / ((truth - truth.mean()) ** 2).sum())


def test_profile(predictions, calls):
    values = per_day(calls, 9)
    sizes = Counter((c[1], c[2]) for c in calls)
    found = [r for r in monitoring.profiles(predictions).collect() if r.column_name == "predicted_fare"]
    assert len(found) == len(values)
    for r in found:
        known = np.sort(np.array(values[r.day, r.model_id]))
        assert (r.rows, r.nulls) == (sizes[r.day, r.model_id], sizes[r.day, r.model_id] - len(known))
        assert (r.distinct_values, r.min, r.max) == (len(set(known)), known[0], known[-1])
        assert r.mean == pytest.approx(known.mean()) and r.stddev == pytest.approx(known.std(ddof=1))
        for share, quantile in ((0.25, r.p25), (0.5, r.p50), (0.75, r.p75)):
            assert quantile == known[math.ceil(share * len(known)) - 1]


def test_spread_far_from_zero(spark):
    values = [1e9 + step / 10 for step in range(100)]
    counts = spark.createDataFrame([("g", v, 1) for v in values], "g string, value double, n long")
    row = dist.profile(counts, ["g"]).first()
    assert row.stddev == pytest.approx(np.std(values, ddof=1)) and round(row.stddev, 2) == 2.90


def test_r2_of_labels_far_from_zero(spark):
    fares = [1e8 + step / 8 for step in range(60)]
    day = datetime(2024, 1, 1)
    asked = [(day, day.date(), "m", float(k % 6), 8, 2, 1, 0, 1, 1e8 + k / 8, str(k)) for k in range(60)]
    trips = spark.createDataFrame([(float(k % 6), 8, 2, 1, 0, 1, fare) for k, fare in enumerate(fares)], KNOWN)
    row = monitoring.quality(spark.createDataFrame(asked, PREDICTED), trips).first()
    pairs = [(float(np.float32(1e8 + a / 8)), fares[b]) for a in range(60) for b in range(60) if a % 6 == b % 6]
    guess, truth = np.array(pairs).T
    assert row.r2 == pytest.approx(1 - ((guess - truth) ** 2).sum() / ((truth - truth.mean()) ** 2).sum())


def test_slices_grow_with_the_values(spark, monkeypatch):
    monkeypatch.setattr(dist, "SLICES", 2)
    monkeypatch.setattr(dist, "VALUES_PER_SLICE", 10)
    counts = spark.createDataFrame([("g", float(v), 2) for v in range(300)], "g string, value double, n long")
    totals = dist.running_totals(counts, ["g"], {"n": "up_to"}).collect()
    assert {r.value: r.up_to for r in totals} == {float(v): 2 * v + 2 for v in range(300)}


def distance_between(now, base):
    now, base = np.sort(now), np.sort(base)
    both = np.concatenate([now, base])
    left = np.searchsorted(now, both, side="right") / len(now)
    right = np.searchsorted(base, both, side="right") / len(base)
    return np.abs(left - right).max()


def stability(now, base, bins=10):
    low, high = min(base), max(base)
    place = lambda v: int(min(bins - 1, max(0, math.floor((v - low) / (high - low) * bins))))
    total = 0.0
    for k in range(bins):
        p = sum(place(v) == k for v in now) / len(now) or monitoring.EMPTY_SHARE
        q = sum(place(v) == k for v in base) / len(base) or monitoring.EMPTY_SHARE
        total += (p - q) * math.log(p / q)
    return total


def table(drift, column):
    return {(r.day, r.model_id, r.statistic): r.drift for r in drift.collect() if r.column_name == column}


@pytest.mark.parametrize("column, place", [("trip_distance", 3), ("predicted_fare", 9)])
def test_numeric_drift_against_the_previous_day(predictions, calls, column, place):
    values = per_day(calls, place)
    found = table(monitoring.numeric_drift(predictions), column)
    compared = dict(days_before(values))
    assert {key[:2] for key in found} == set(compared)
    for key, before in compared.items():
        now, base = values[key], values[before]
        assert found[(*key, "mean_shift")] == pytest.approx(np.mean(now) - np.mean(base))
        assert found[(*key, "ks")] == pytest.approx(distance_between(now, base))
        assert found[(*key, "psi")] == pytest.approx(stability(now, base))


def test_numeric_drift_against_a_baseline(spark, predictions, calls):
    base = [k / 8 for k in range(4, 300)]
    baseline = spark.createDataFrame([(b, b) for b in base], "trip_distance double, predicted_fare double")
    values = per_day(calls, 3)
    found = table(monitoring.numeric_drift(predictions, baseline), "trip_distance")
    assert {key[:2] for key in found} == set(values)
    for key, now in values.items():
        assert found[(*key, "ks")] == pytest.approx(distance_between(now, base))
        assert found[(*key, "psi")] == pytest.approx(stability(now, base))


@pytest.mark.parametrize("against_baseline", [False, True])
def test_categorical_drift(spark, predictions, calls, against_baseline):
    values = per_day(calls, 4)
    everything = [c[4] for c in calls]
    if against_baseline:
        names = list(monitoring.CATEGORICAL)
        baseline = spark.createDataFrame([c[4:9] for c in calls], ", ".join(f"{n} int" for n in names))
        compared = {key: everything for key in values}
        drift = monitoring.categorical_drift(predictions, baseline)
    else:
        compared = {key: values[before] for key, before in days_before(values)}
        drift = monitoring.categorical_drift(predictions)
    found = table(drift, "pickup_hour")
    assert {key[:2] for key in found} == set(compared)
    for key, base in compared.items():
        now, base = Counter(values[key]), Counter(base)
        size, base_size = sum(now.values()), sum(base.values())
        hours = set(now) | set(base)
        shift = sum(abs(now[h] / size - base[h] / base_size) for h in hours) / 2
        expected = {h: size * (base[h] / base_size or monitoring.EMPTY_SHARE) for h in hours}
        chi = sum((now[h] - expected[h]) ** 2 / expected[h] for h in hours)
        assert found[(*key, "total_variation")] == pytest.approx(shift)
        assert found[(*key, "chi_square")] == pytest.approx(chi)


def test_constant_column_has_no_drift(spark):
    calls = [(datetime(2024, 1, day, 1), datetime(2024, 1, day).date(), "a", 2.0, 1, 1, 1, 0, 0, 8.0, "x") for day in (1, 2)]
    drift = monitoring.numeric_drift(spark.createDataFrame(calls, PREDICTED))
    assert {r.drift for r in drift.collect()} == {0.0}


@pytest.mark.parametrize("slices", [2, 7, 64])
def test_running_totals_whatever_the_slices(spark, slices):
    draw = random.Random(slices)
    counts = {(g, draw.uniform(-5, 5) ** 3): draw.randrange(1, 9) for g in "xyz" for _ in range(300)}
    df = spark.createDataFrame([(g, v, n) for (g, v), n in counts.items()], "g string, value double, n long")
    found = dist.running_totals(df.repartition(5), ["g"], {"n": "upto"}, slices)
    assert found.count() == len(counts)
    for r in found.collect():
        assert r.upto == sum(n for (g, v), n in counts.items() if g == r.g and v <= r.value)


def test_value_counts_and_quantiles_of_a_hot_value(spark):
    values = [1.0] * 500 + [float(v) for v in range(2, 1002)] + [None] * 7
    df = spark.createDataFrame([("g", v) for v in values], "g string, x double")
    counts = dist.value_counts(df, ["g"], ["x"])
    assert counts.count() == 1002
    assert counts.filter(F.col("value").isNull()).first().n == 7
    row = dist.quantiles(counts, ["g", "column_name"], {"low": 0.3, "mid": 0.5, "all": 1.0}).first()
    ordered = sorted(v for v in values if v is not None)
    assert (row.low, row.mid, row.all) == (ordered[449], ordered[749], ordered[-1])
