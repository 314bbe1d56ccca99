"""Scoring whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.plans.training import RAW_PREDICTION, all_inputs_known, apply_model
from goldleaf.schemas import FEATURE_COLUMNS, LABEL, PREDICTION

Predictor = Callable[[pd.DataFrame], np.ndarray]


def _output(scored: DataFrame, score: Column, model_version: str) -> DataFrame:
    return scored.select(
        *FEATURE_COLUMNS,
        LABEL,
        score.cast("float").alias(PREDICTION),
        F.current_timestamp().alias("prediction_timestamp"),
        F.lit(model_version).alias("model_version"),
    )


def score_table(features: DataFrame, model: PipelineModel, model_version: str) -> DataFrame:
    """Every feature row with its predicted fare, the time of the run and the model's version.

    A row with a missing input keeps its place with a null fare. A Spark ML model ships to the
    executors with the plan and scores inside the JVM; no shuffle.
    """
    return _output(apply_model(model, features), F.col(RAW_PREDICTION), model_version)


def score_with_predictor(features: DataFrame, load: Callable[[], Predictor], model_version: str) -> DataFrame:
    """The same for a model of any other library, as Arrow batches of the feature struct.

    ``load`` runs once per task and returns a function from a batch to one number per row. What it
    says of a row with a missing input is replaced by null.
    """
    @F.pandas_udf("float")
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        predictor = load()
        for batch in batches:
            yield pd.Series(np.asarray(predictor(batch), dtype="float32"))

    inputs = F.struct(*FEATURE_COLUMNS)
    return _output(features, F.when(all_inputs_known(), predict(inputs)), model_version)
