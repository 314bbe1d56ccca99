"""Monitoring tables kept up to date day by day: only days whose calls or labels changed are computed and written again.

Every table of ``refresh_monitoring`` is partitioned by day here. Beside them lie ``logged_days``, a line per day of the log
with the number of its successful calls and a fingerprint of them (a sum of hashes, which does not hang on order), and
``value_counts``, the counts that profiles and drift are computed from, and ``profile_sketches``, which merge into profiles of several days.

A refresh compares the log's days with those lines. Touched days are unpacked, counted and profiled again; drift looks back at the
model's previous day, so the next day of each touched model is computed again too, from stored counts. New or changed labels
touch, for quality and ground truth alone, the days whose predictions have the feature vectors in question. Days that the
log no longer has go away. ``logged_days`` is written last: a refresh that breaks off is done again by the next one, and
replacing a day twice gives the same day.

Which days there are comes to the driver, a line per day at most. ``since`` leaves the log before a day unread and its days as
they are. A log without a successful call changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from goldleaf.operators.changes import snapshot_changes
from goldleaf.plans import inference_log, monitoring, monitoring_windows
from goldleaf.plans.fare_jobs import LAYOUTS, Place
from goldleaf.schemas import FEATURE_COLUMNS, PAYLOAD_LOG, require_columns
from goldleaf.sources.tables import Layout, create_schema, discarding, replace_partitions, stored

DAY = "day"
LOGGED_DAYS, COUNTS, LABELS = "logged_days", "value_counts", "known_labels"
SKETCHES = "profile_sketches"
BY_DAY = {
    name: replace(layout, partition_by=(DAY,), gather_by=(), properties={"quality": "metric"})
    for name, layout in LAYOUTS.items()
    if name.startswith("monitor_") or name in ("inferences", "inference_processed")
} | {
    COUNTS: Layout("Values per day, model and column", partition_by=(DAY,)),
    SKETCHES: Layout("Mergeable profile per day, model and column", partition_by=(DAY,)),
}


def call_day() -> Column:
    return F.to_date("request_time")


def logged_days(log: DataFrame) -> DataFrame:
    """Calls and their fingerprint per day of a log."""
    columns = sorted(PAYLOAD_LOG.fieldNames())
    digest = F.xxhash64(*(F.col(name) for name in columns)).cast("decimal(38,0)")
    return log.groupBy(call_day().alias(DAY)).agg(F.count(F.lit(1)).alias("calls"), F.sum(digest).alias("fingerprint"))


def on_days(df: DataFrame, days: Sequence[date | None], day: Column | None = None) -> DataFrame:
    """Rows of these days; on a table partitioned by day this picks partitions."""
    day = F.col(DAY) if day is None else day
    known = [value for value in days if value is not None]
    chosen = day.isin(known) if known else F.lit(False)
    return df.where(chosen | day.isNull() if None in days else chosen)


def changed_days(place: Place, log: DataFrame, since: date | None) -> tuple[list, list]:
    """Days of the log that are new or have other calls than last time, and days that it no longer has."""
    now = logged_days(log)
    if not place.has(LOGGED_DAYS):
        return [row[DAY] for row in now.select(DAY).collect()], []
    before = place.read(LOGGED_DAYS)
    before = before if since is None else before.where(F.col(DAY) >= F.lit(since))
    both = now.alias("n").join(before.alias("b"), F.col(f"n.{DAY}").eqNullSafe(F.col(f"b.{DAY}")), "full_outer")
    same = F.col("n.calls").eqNullSafe(F.col("b.calls")) & F.col("n.fingerprint").eqNullSafe(F.col("b.fingerprint"))
    found = both.where(~same).select(F.coalesce(f"n.{DAY}", f"b.{DAY}").alias(DAY), F.col("n.calls").isNull().alias("gone"))
    rows = found.collect()
    return [row[DAY] for row in rows if not row["gone"]], [row[DAY] for row in rows if row["gone"]]


def days_of_labels(place: Place, labels: DataFrame) -> list:
    """Days with predictions whose feature vectors have other labels than last time."""
    if not place.has(LABELS):
        return []
    changed = snapshot_changes(place.read(LABELS), labels, [*FEATURE_COLUMNS]).select(*FEATURE_COLUMNS).distinct()
    met = place.read("inferences").join(changed, list(FEATURE_COLUMNS), "left_semi")
    return [row[DAY] for row in met.select(DAY).distinct().collect()]


def following_days(model_days: DataFrame, touched: Sequence) -> list:
    """The days whose drift looks at a touched day: these days and the next day of each model, also where a touched day is gone."""
    marks = F.array(*(F.lit(day).cast("date") for day in touched))
    marked = model_days.select("model_id").distinct().select("model_id", F.explode(marks).alias(DAY))
    order = W.partitionBy("model_id").orderBy(DAY)
    placed = model_days.union(marked).distinct().withColumns(
        {"_before": F.lag(DAY).over(order), "_first": F.row_number().over(order) == 1}
    )
    looking_back = placed.where(on_condition(touched, F.col(DAY)) | (~F.col("_first") & on_condition(touched, F.col("_before"))))
    return [row[DAY] for row in looking_back.select(DAY).distinct().collect()]


def on_condition(days: Sequence, day: Column) -> Column:
    known = [value for value in days if value is not None]
    chosen = F.coalesce(day.isin(known), F.lit(False)) if known else F.lit(False)
    return chosen | day.isNull() if None in days else chosen


def refresh_days(
    place: Place, log: DataFrame, features: DataFrame, call_id: Column | None = None, since: date | None = None
) -> dict[str, list]:
    """Bring all tables up to the log and the features. Gives the days that each table was written for."""
    require_columns(log, PAYLOAD_LOG)
    spark = place.spark
    create_schema(spark, place.schema, place.folder)
    log = log.where(F.col("status_code") == inference_log.SUCCESS)
    log = log if since is None else log.where(call_day() >= F.lit(since))
    if since is None and log.isEmpty():
        return {}
    written: dict[str, list] = {}

    def write(name: str, df: DataFrame, days: list, gone: DataFrame) -> None:
        """Days that get no rows any more are removed."""
        rows = stored(df, name)
        missing = gone.unionByName(spark.createDataFrame([(day,) for day in days], "day date")).join(
            rows.select(DAY).distinct().withColumnRenamed(DAY, "_has"), F.col(DAY).eqNullSafe(F.col("_has")), "left_anti"
        )
        replace_partitions(rows, f"{place.schema}.{name}", f"{place.folder}/{name}", BY_DAY[name], missing)
        written[name] = sorted(days, key=str)

    with discarding(spark):
        days, lost = changed_days(place, log, since)
        labels = stored(inference_log.known_labels(features), "labels")
        judged = sorted({*days, *days_of_labels(place, labels)} - set(lost), key=str)
        gone = spark.createDataFrame([(day,) for day in lost], "day date")
        if days or lost:
            unpacked = inference_log.unpack_payloads(on_days(log, days, call_day()), call_id).withColumn(DAY, F.to_date("timestamp"))
            write("inferences", unpacked, days, gone)
            new = on_days(place.read("inferences"), days)
            write(COUNTS, monitoring.counted_values(new), days, gone)
            write(SKETCHES, monitoring_windows.daily_sketches(new), days, gone)
            write("monitor_volume", monitoring.volume(new), days, gone)
            counts = place.read(COUNTS)
            write("monitor_profile", monitoring.profiles_of(on_days(counts, days)), days, gone)
            model_days = stored(counts.select("model_id", DAY).distinct(), "model-days")
            drifting = sorted(set(following_days(model_days, [*days, *lost])) - set(lost), key=str)
            looked_at = stored(on_days(counts, sorted({*drifting, *_days_before(model_days, drifting)}, key=str)), "counts")
            for name, drift in (
                ("monitor_drift_numeric", monitoring.numeric_drift_of), ("monitor_drift_categorical", monitoring.categorical_drift_of)
            ):
                write(name, on_days(drift(looked_at), drifting), drifting, gone)
        if judged or lost:
            asked = on_days(place.read("inferences"), judged)
            write("monitor_quality", monitoring.quality_against(asked, labels), judged, gone)
            processed = inference_log.join_labels(asked, labels).withColumn(DAY, F.to_date("timestamp"))
            write("inference_processed", processed, judged, gone)
        place.store(LABELS, labels, LAYOUTS[LABELS])
        seen = logged_days(log)
        if since is not None and place.has(LOGGED_DAYS):
            seen = seen.unionByName(place.read(LOGGED_DAYS).where(F.col(DAY) < F.lit(since)))
        place.store(LOGGED_DAYS, seen)
    return written


def _days_before(model_days: DataFrame, days: Sequence) -> list:
    """Each model's day before one of these days."""
    placed = model_days.withColumn("_before", F.lag(DAY).over(W.partitionBy("model_id").orderBy(DAY)))
    return [row["_before"] for row in placed.where(on_condition(days, F.col(DAY))).select("_before").distinct().collect() if row["_before"]]
