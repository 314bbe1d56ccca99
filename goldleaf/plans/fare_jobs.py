"""The three recurring jobs around the fare model, each leaving its results as tables of a schema:
train and compare, score, monitor."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.operators.splitting import split_rows
from goldleaf.plans import champion, inference_log, monitoring, scoring, training, trip_features
from goldleaf.plans.tracked import overwrite_tracked
from goldleaf.schemas import FEATURE_COLUMNS, LABEL, PAYLOAD_LOG, TRIPS, require_columns
from goldleaf.sources.tables import Layout, append_table, create_schema, discarding, overwrite_table, stored

FEATURES = "feature_table"
PREDICTIONS = "predictions"
RUNS = "training_runs"
DECISIONS = "champion_decisions"

_TRACKED, _METRIC = {"changes": "tracked"}, {"quality": "metric"}
LAYOUTS = {
    FEATURES: Layout("Model inputs and fares of valid trips", {"quality": "gold"}),
    PREDICTIONS: Layout("Every feature row with its predicted fare", {"quality": "gold"}),
    "inferences": Layout("Logged predictions, one row each", {"quality": "silver"}, gather_by=("date",)),
    "known_labels": Layout("Fares per feature vector, counted", {"quality": "silver"}),
    "inference_processed": Layout("Logged predictions with their ground truth", _TRACKED, gather_by=("date",)),
    "monitor_volume": Layout("Predictions per day and model", _METRIC, gather_by=("day",)),
    "monitor_quality": Layout("Errors per day and model", _METRIC, gather_by=("day",)),
    "monitor_profile": Layout("Values per day, model and column", _METRIC, gather_by=("day",)),
    "monitor_drift_numeric": Layout("Drift of numbers per day and model", _METRIC, gather_by=("day",)),
    "monitor_drift_categorical": Layout("Drift of categories per day and model", _METRIC, gather_by=("day",)),
}
# What identifies a row of a tracked table; the fare only where every different fare has a row.
TRACKED_KEYS = {"inference_processed": ("example_id", LABEL)}


@dataclass(frozen=True)
class Place:
    """A schema and the folder its tables and models lie in."""

    spark: SparkSession
    schema: str
    folder: str

    def store(self, name: str, df: DataFrame, layout: Layout = Layout()) -> DataFrame:
        """Replace a table; what changed in a tracked one goes to ``<name>_changes``."""
        create_schema(self.spark, self.schema, self.folder)
        place = (f"{self.schema}.{name}", f"{self.folder}/{name}", layout)
        if layout.properties.get("changes") == "tracked":
            return overwrite_tracked(df, *place, TRACKED_KEYS[name])
        return overwrite_table(df, *place)

    def append(self, name: str, df: DataFrame) -> DataFrame:
        create_schema(self.spark, self.schema, self.folder)
        return append_table(df, f"{self.schema}.{name}", f"{self.folder}/{name}")

    def has(self, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.schema}.{name}")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.table(f"{self.schema}.{name}")

    def model_path(self, run_id: str) -> str:
        return f"{self.folder}/models/{run_id}"


def store_features(place: Place, trips: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    require_columns(trips, TRIPS)
    return place.store(FEATURES, trip_features.feature_table(trips, keep), LAYOUTS[FEATURES])


def champion_run(place: Place) -> str | None:
    """The run whose model last won a comparison; none before the first."""
    if not place.spark.catalog.tableExists(f"{place.schema}.{DECISIONS}"):
        return None
    won = place.read(DECISIONS).filter("is_better")
    return won.agg(F.max_by("run_id", "decided_at")).first()[0]


def load_champion(place: Place) -> tuple[str, PipelineModel] | None:
    run_id = champion_run(place)
    return None if run_id is None else (run_id, PipelineModel.load(place.model_path(run_id)))


def train_and_compare(
    place: Place,
    run_id: str,
    grid: Mapping[str, Sequence[float]] = training.PARAMETER_GRID,
    row_id: Sequence[str] = (*FEATURE_COLUMNS, LABEL),
) -> DataFrame:
    """Search on the stored feature table, save the model, and append the run's record and the
    verdict on it. Gives the verdict: one row, with ``is_better`` when it is the new champion."""
    train, test = split_rows(place.read(FEATURES), row_id)
    found = training.search_fare_model(train, grid, row_id=row_id)
    found.model.write().overwrite().save(place.model_path(run_id))
    record = training.training_run(train, training.apply_model(found.model, test), FEATURES, found.best)
    place.append(RUNS, record.withColumn("run_id", F.lit(run_id)))
    current = load_champion(place)
    verdict = champion.compare_models(test, found.model, current[1] if current else None)
    decided = verdict.withColumns({"run_id": F.lit(run_id), "decided_at": F.current_timestamp()})
    return place.append(DECISIONS, decided).filter(F.col("run_id") == run_id)


def score_features(place: Place) -> DataFrame:
    """Score the stored feature table with the champion and store the predictions."""
    current = load_champion(place)
    if current is None:
        raise ValueError("no champion yet: train first")
    run_id, model = current
    return place.store(PREDICTIONS, scoring.score_table(place.read(FEATURES), model, run_id), LAYOUTS[PREDICTIONS])


def refresh_monitoring(
    place: Place,
    log: DataFrame,
    features: DataFrame,
    call_id: Column | None = None,
    baseline: DataFrame | None = None,
    every_label: bool = False,
) -> dict[str, DataFrame]:
    """Unpack the log once, then recompute the processed table and all metric tables from it.

    The processed table has one row per prediction, with the mean fare of the matching trips and
    their number; what fares those were is stored once per feature vector in ``known_labels``.
    ``every_label`` lays the two together: one row per prediction and different fare, which for
    a vector shared by many predictions and many fares is a far larger table. The metrics need
    neither and are the same both ways.

    A log without a successful call changes nothing: all tables stay as they are, and the result is
    empty. Intermediate tables are removed at the end.
    """
    require_columns(log, PAYLOAD_LOG)
    if log.filter(F.col("status_code") == inference_log.SUCCESS).isEmpty():
        return {}
    with discarding(place.spark):
        unpacked = place.store("inferences", inference_log.unpack_payloads(log, call_id), LAYOUTS["inferences"])
        labels = place.store("known_labels", inference_log.known_labels(features), LAYOUTS["known_labels"])
        counts = stored(monitoring.counted_values(unpacked), "value-counts")
        metrics = {
            "inference_processed": inference_log.join_labels(unpacked, labels, every_label),
            "monitor_volume": monitoring.volume(unpacked),
            "monitor_quality": monitoring.quality_against(unpacked, labels),
            "monitor_profile": monitoring.profiles_of(counts),
            "monitor_drift_numeric": monitoring.numeric_drift_of(counts, baseline),
            "monitor_drift_categorical": monitoring.categorical_drift_of(counts, baseline),
        }
        tables = {name: place.store(name, df, LAYOUTS[name]) for name, df in metrics.items()}
    return {"inferences": unpacked, "known_labels": labels, **tables}
