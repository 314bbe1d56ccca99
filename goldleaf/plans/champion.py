"""Does a new model replace the current one? Only with a strictly lower error."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.plans.training import apply_model
from goldleaf.schemas import FEATURE_COLUMNS, LABEL


def is_better(challenger_error: Column, champion_error: Column, has_champion: bool) -> Column:
    """True on a strictly lower error, and without a champion to beat.

    An error that is not known (nothing was scored, or the run was never logged) is never better,
    and nothing is better than a champion whose error is not known.
    """
    if not has_champion:
        return challenger_error.isNotNull()
    return F.coalesce(challenger_error < champion_error, F.lit(False))


def _decision(errors: DataFrame, has_champion: bool) -> DataFrame:
    verdict = is_better(F.col("challenger_mae"), F.col("champion_mae"), has_champion)
    return errors.select("champion_mae", "challenger_mae", verdict.alias("is_better"))


def compare_models(
    holdout: DataFrame, challenger: PipelineModel, champion: PipelineModel | None = None
) -> DataFrame:
    """One row: both errors on the same holdout, and the verdict.

    Both models score each row in one pass over the holdout.
    """
    rows = holdout.select(*FEATURE_COLUMNS, LABEL)
    scored = _scored(rows, challenger, "_challenger")
    if champion is not None:
        scored = _scored(scored, champion, "_champion")
    else:
        scored = scored.withColumn("_champion", F.lit(None).cast("double"))
    return _decision(
        scored.agg(
            F.avg(F.abs(F.col("_champion") - F.col(LABEL))).alias("champion_mae"),
            F.avg(F.abs(F.col("_challenger") - F.col(LABEL))).alias("challenger_mae"),
        ),
        champion is not None,
    )


def compare_logged(runs: DataFrame, challenger_run: str, champion_run: str | None) -> DataFrame:
    """The same verdict from the errors two runs logged (columns ``run_id``, ``test_mae``)."""
    def logged(run: str | None) -> Column:
        return F.max(F.when(F.col("run_id") == F.lit(run), F.col("test_mae")))

    chosen = runs.filter(F.col("run_id").isin([run for run in (challenger_run, champion_run) if run]))
    return _decision(
        chosen.agg(logged(champion_run).alias("champion_mae"), logged(challenger_run).alias("challenger_mae")),
        champion_run is not None,
    )


def _scored(rows: DataFrame, model: PipelineModel, name: str) -> DataFrame:
    return apply_model(model, rows, name)
