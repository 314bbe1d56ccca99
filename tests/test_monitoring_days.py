"""Monitoring by touched days: which partitions are written, and that the tables equal a full run."""

import uuid

import pytest
from pyspark.sql import functions as F

from goldleaf.plans import fare_jobs, monitoring_days, trip_features
from goldleaf.session import run_folder
from goldleaf.sources import sample_tables as sample
from goldleaf.sources.tables import stored

SMALL = "/root/testdata/sf0.001"
METRICS = ("monitor_volume", "monitor_quality", "monitor_profile", "monitor_drift_numeric", "monitor_drift_categorical")


def new_place(spark):
    return fare_jobs.Place(spark, f"t_{uuid.uuid4().hex[:10]}", run_folder(spark, "test"))


@pytest.fixture(scope="module")
def material(spark):
    """A log of some days, its days in order, and features."""
    log = stored(sample.payload_log(spark, SMALL), "test")
    features = stored(trip_features.feature_table(sample.trips(spark, SMALL)), "test")
    good = log.where("status_code = '200' AND request_time IS NOT NULL")
    days = sorted(row[0] for row in good.select(F.to_date("request_time")).distinct().collect())[:6]
    return log.where(F.to_date("request_time").isin(days)), days, features


def files_by_day(place, name):
    rows = place.read(name).select("day", F.input_file_name()).distinct().collect()
    return {(row[0], row[1]) for row in rows}


def assert_full(spark, place, log, features):
    """All tables equal those of the job that recomputes everything."""
    other = new_place(spark)
    full = fare_jobs.refresh_monitoring(other, log, features, F.col("request_id"))
    for name in (*METRICS, "inferences", "inference_processed"):
        found = place.read(name).select(*full[name].columns)
        assert found.count() == full[name].count()
        if name.startswith("monitor_drift"):  # sums of logarithms hang on their order
            found, expected = (df.withColumn("drift", F.round("drift", 9)) for df in (found, full[name]))
        elif name == "monitor_profile":
            rounded = {column: F.round(column, 9) for column in ("mean", "stddev")}
            found, expected = found.withColumns(rounded), full[name].withColumns(rounded)
        else:
            expected = full[name]
        assert found.exceptAll(expected).count() == 0, name


def test_a_new_day_rewrites_that_day_alone(spark, material):
    log, days, features = material
    place, day = new_place(spark), F.to_date("request_time")
    early = log.where(day.isin(days[:4] + days[5:]))  # the fifth day comes late, so the sixth has another day before it
    first = monitoring_days.refresh_days(place, early, features, F.col("request_id"))
    assert first["monitor_volume"] == days[:4] + days[5:]
    before = {name: files_by_day(place, name) for name in (*METRICS, "inferences", "inference_processed")}
    second = monitoring_days.refresh_days(place, log, features, F.col("request_id"))
    assert second["inferences"] == second["monitor_profile"] == [days[4]]
    for name, files in before.items():
        touched = {entry[0] for entry in files ^ files_by_day(place, name)}
        assert touched == (set(days[4:]) if "drift" in name else {days[4]}), name
    assert_full(spark, place, log, features)
    assert monitoring_days.refresh_days(place, log, features, F.col("request_id")) == {}


def test_changed_lost_and_relabelled_days(spark, material, monkeypatch):
    log, days, features = material
    place, day = new_place(spark), F.to_date("request_time")
    monitoring_days.refresh_days(place, log, features, F.col("request_id"))
    # calls of one day change, another day goes, and labels of some vectors change
    changed = log.where((day != days[1]) & ~((day == days[3]) & (F.col("request_id") % 2 == 0)))
    vector = features.where("trip_distance IS NOT NULL").orderBy("trip_distance", "pickup_hour", "pickup_dayofweek").first()
    same = (F.col("trip_distance") == vector.trip_distance) & (F.col("pickup_hour") == vector.pickup_hour)
    relabelled = features.withColumn("fare_amount", F.when(same, F.col("fare_amount") + 1).otherwise(F.col("fare_amount")))
    # the refresh breaks off before it notes the days
    monkeypatch.setattr(fare_jobs.Place, "store", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        monitoring_days.refresh_days(place, changed, relabelled, F.col("request_id"))
    monkeypatch.undo()
    written = monitoring_days.refresh_days(place, changed, relabelled, F.col("request_id"))
    assert written["inferences"] == [days[3]] and days[1] not in written["monitor_quality"]
    assert set(written["monitor_quality"]) >= {days[3]}
    assert_full(spark, place, changed, relabelled)


def test_since_leaves_earlier_days_alone(spark, material):
    log, days, features = material
    place, day = new_place(spark), F.to_date("request_time")
    monitoring_days.refresh_days(place, log.where(day < days[5]), features, F.col("request_id"))
    # the rest of the log is not delivered any more; that does not remove its days
    written = monitoring_days.refresh_days(place, log.where(day == days[5]), features, F.col("request_id"), since=days[5])
    assert written["monitor_volume"] == [days[5]]
    assert_full(spark, place, log, features)
    empty = log.where("FALSE")
    assert monitoring_days.refresh_days(place, empty, features, F.col("request_id")) == {}
