"""Features, training, scoring and the champion decision on trips."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.operators.splitting import split_rows
from goldleaf.plans import champion, scoring, training, trip_features
from goldleaf.queries.common import query, with_tables
from goldleaf.schemas import FEATURE_COLUMNS
from goldleaf.session import run_folder
from goldleaf.sources import sample_tables as sample

TRIPS = """
trips AS (
  SELECT event_id AS trip_id, CASE WHEN event_id % 101 <> 7 THEN ts END AS tpep_pickup_datetime,
         CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DOUBLE) / 4 AS trip_distance,
         floor(value * 8) / 8 AS fare_amount
  FROM events
)"""

INPUTS = """
inputs AS (
  SELECT trip_id, tpep_pickup_datetime, trip_distance,
         CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
         CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_dayofweek,
         CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
         CASE WHEN dayofweek(tpep_pickup_datetime) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN hour(tpep_pickup_datetime) IN (7, 8, 9, 16, 17, 18, 19) THEN 1 ELSE 0 END AS is_rush_hour,
         fare_amount
  FROM trips
)"""

FEATURES = """
features AS (
  SELECT * EXCLUDE (tpep_pickup_datetime) FROM inputs
  WHERE fare_amount > 0 AND fare_amount < 200 AND trip_distance > 0
)"""

SPLIT = """
split AS (
  SELECT *, CAST('0x' || substr(md5('42|' || CAST(trip_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 < 2000 AS for_test
  FROM features
)"""


def _features(spark, folder, keep=()):
    return trip_features.feature_table(sample.trips(spark, folder), keep)


def fixed_model(base: float, per_mile: float) -> PipelineModel:
    """A stand-in with known outputs: a linear fare as a Spark ML stage."""
    statement = f"SELECT *, {base!r}D + {per_mile!r}D * trip_distance AS {training.RAW_PREDICTION} FROM __THIS__"
    return PipelineModel([SQLTransformer(statement=statement)])


_SIX = ", ".join(FEATURE_COLUMNS)


@query("taxi_features", with_tables(f"SELECT {_SIX}, fare_amount FROM features", TRIPS, INPUTS, FEATURES))
def _(spark, folder):
    return _features(spark, folder)


@query(
    "drop_null_features",
    with_tables(
        f"SELECT trip_id, {_SIX} FROM inputs WHERE trip_distance > 2 AND pickup_hour > 3", TRIPS, INPUTS
    ),
)
def _(spark, folder):
    inputs = sample.trip_inputs(spark, folder).drop("tpep_pickup_datetime")
    known = {
        "trip_distance": F.when(F.col("trip_distance") > 2, F.col("trip_distance")),
        "pickup_hour": F.when(F.col("pickup_hour") > 3, F.col("pickup_hour")),
    }
    return trip_features.without_null_inputs(inputs.withColumns(known))


@query(
    "train_test_split",
    with_tables("SELECT trip_id, fare_amount, for_test FROM split", TRIPS, INPUTS, FEATURES, SPLIT),
)
def _(spark, folder):
    train, test = split_rows(_features(spark, folder, ["trip_id"]), ["trip_id"])
    sides = train.withColumn("for_test", F.lit(False)).unionByName(test.withColumn("for_test", F.lit(True)))
    return sides.select("trip_id", "fare_amount", "for_test")


# Trips without pickup time have no hour, weekday and month; their distances are all known.
_KNOWN = "pickup_hour IS NOT NULL"
_ERRORS = """
  avg(abs(3 + 2.5 * trip_distance - fare_amount)) AS test_mae,
  sqrt(avg((3 + 2.5 * trip_distance - fare_amount) * (3 + 2.5 * trip_distance - fare_amount))) AS test_rmse,
  round(1 - avg((3 + 2.5 * trip_distance - fare_amount) * (3 + 2.5 * trip_distance - fare_amount))
            / var_pop(fare_amount), 6) AS test_r2
"""
_ERRORS = _ERRORS.replace("3 + 2.5 *", "3.0::DOUBLE + 2.5::DOUBLE *")


def _rounded(df):
    return df.withColumn("test_r2", F.round("test_r2", 6))


@query("regression_metrics", with_tables(f"SELECT {_ERRORS} FROM features WHERE {_KNOWN}", TRIPS, INPUTS, FEATURES))
def _(spark, folder):
    scored = training.apply_model(fixed_model(3.0, 2.5), _features(spark, folder))
    return _rounded(training.regression_metrics(scored))


@query(
    "training_run_record",
    with_tables(
        f"""SELECT 'trips' AS dataset, '{",".join(FEATURE_COLUMNS)}' AS feature_columns,
                   'base=3.0,per_mile=2.5' AS parameters,
                   (SELECT count(*) FROM split WHERE NOT for_test AND {_KNOWN}) AS training_samples,
                   count(*) AS test_samples, {_ERRORS} FROM split WHERE for_test AND {_KNOWN}""",
        TRIPS,
        INPUTS,
        FEATURES,
        SPLIT,
    ),
)
def _(spark, folder):
    train, test = split_rows(_features(spark, folder, ["trip_id"]), ["trip_id"])
    scored = training.apply_model(fixed_model(3.0, 2.5), test)
    return _rounded(training.training_run(train, scored, "trips", {"base": 3.0, "per_mile": 2.5}))


_GATE = f"""
  SELECT avg(abs(5.0::DOUBLE + 2.0::DOUBLE * trip_distance - fare_amount)) AS a,
         avg(abs(3.0::DOUBLE + 2.5::DOUBLE * trip_distance - fare_amount)) AS b
  FROM split WHERE for_test AND {_KNOWN}"""


@query(
    "champion_gate",
    with_tables(
        f"""SELECT k AS "case", champion_mae, challenger_mae, is_better FROM ({_GATE}), LATERAL (VALUES
             ('challenger against champion', a, b, b < a), ('champion against challenger', b, a, a < b),
             ('equal errors', b, b, FALSE), ('no champion', NULL, b, TRUE),
             ('empty holdout', NULL, NULL, FALSE), ('empty holdout, no champion', NULL, NULL, FALSE),
             ('logged', a, b, b < a), ('challenger never logged', a, NULL, FALSE), ('champion never logged', NULL, b, FALSE)
           ) AS cases(k, champion_mae, challenger_mae, is_better)""",
        TRIPS,
        INPUTS,
        FEATURES,
        SPLIT,
    ),
)
def _(spark, folder):
    """One line per case of the gate, on the holdout and on logged errors."""
    _, holdout = split_rows(_features(spark, folder, ["trip_id"]), ["trip_id"])
    a, b, nothing = fixed_model(5.0, 2.0), fixed_model(3.0, 2.5), holdout.where("FALSE")
    runs = champion.compare_models(holdout, b, a).select(
        F.explode(F.array(
            F.struct(F.lit("a").alias("run_id"), F.col("champion_mae").alias("test_mae")),
            F.struct(F.lit("b").alias("run_id"), F.col("challenger_mae").alias("test_mae")),
        )).alias("run")
    ).select("run.*")
    cases = {
        "challenger against champion": champion.compare_models(holdout, b, a),
        "champion against challenger": champion.compare_models(holdout, a, b),
        "equal errors": champion.compare_models(holdout, b, b),
        "no champion": champion.compare_models(holdout, b),
        "empty holdout": champion.compare_models(nothing, b, a),
        "empty holdout, no champion": champion.compare_models(nothing, b),
        "logged": champion.compare_logged(runs, "b", "a"),
        "challenger never logged": champion.compare_logged(runs, "c", "a"),
        "champion never logged": champion.compare_logged(runs, "b", "c"),
    }
    lines = [df.select(F.lit(name).alias("case"), "*") for name, df in cases.items()]
    return reduce(DataFrame.union, lines)


_SCORED = with_tables(
    f"""SELECT {_SIX}, fare_amount, CASE WHEN {_KNOWN} THEN CAST(3 + 2.5 * trip_distance AS FLOAT) END AS predicted_fare,
               '7' AS model_version
        FROM features""",
    TRIPS,
    INPUTS,
    FEATURES,
)


@query("score_table", _SCORED)
def _(spark, folder):
    scored = scoring.score_table(_features(spark, folder), fixed_model(3.0, 2.5), "7")
    return scored.drop("prediction_timestamp")


def _load_linear():
    return lambda batch: 3.0 + 2.5 * batch["trip_distance"].to_numpy()


@query("score_with_predictor", _SCORED)
def _(spark, folder):
    scored = scoring.score_with_predictor(_features(spark, folder), _load_linear, "7")
    return scored.drop("prediction_timestamp")


_FOLD = "CAST('0x' || substr(md5('fold|' || CAST(trip_id AS VARCHAR)), 1, 8) AS BIGINT) % 3"


@query(
    "train_fare_model",
    with_tables(
        f"""SELECT count(*) FILTER (NOT for_test AND {_KNOWN}) AS training_samples,
                   count(*) FILTER (for_test AND {_KNOWN}) AS test_samples, CAST(12 AS BIGINT) AS grid_points,
                   count(*) FILTER (NOT for_test AND {_KNOWN} AND {_FOLD} = 0) AS fold_0,
                   count(*) FILTER (NOT for_test AND {_KNOWN} AND {_FOLD} = 1) AS fold_1,
                   count(*) FILTER (NOT for_test AND {_KNOWN} AND {_FOLD} = 2) AS fold_2,
                   count(*) FILTER (for_test) AS rows_scored, TRUE AS best_has_lowest_error, TRUE AS close_to_training_mean
            FROM split""",
        TRIPS,
        INPUTS,
        FEATURES,
        SPLIT,
    ),
)
def _(spark, folder):
    """Search the whole default grid on the stored feature table; sizes, and what must hold of any good fit.

    Fares of the supplied events hang on nothing, so no model can beat their mean by much; a
    sound one is not much worse on the holdout either. Tests fit fares that do hang on the distance.
    """
    place = run_folder(spark, "features")
    _features(spark, folder, ["trip_id"]).write.parquet(place)
    train, test = split_rows(spark.read.parquet(place), ["trip_id"])
    found = training.search_fare_model(train, training.PARAMETER_GRID, row_id=["trip_id"])
    errors = [error for _, error in found.scores]
    lowest = min(zip(errors, (point for point, _ in found.scores)), key=lambda pair: pair[0])[1]
    known = training.trainable(train)
    fold = training.fold_number(["trip_id"])
    sizes = known.agg(
        F.count(F.lit(1)).alias("training_samples"), F.avg("fare_amount").alias("_mean"),
        *(F.count_if(fold == k).alias(f"fold_{k}") for k in range(training.FOLDS)),
    ).withColumn("_one", F.lit(1))
    scored = training.apply_model(found.model, test)
    mean = sizes.first()["_mean"]
    error = F.abs(F.col(training.RAW_PREDICTION) - F.col("fare_amount"))
    off = F.when(F.col(training.RAW_PREDICTION).isNotNull(), F.abs(F.col("fare_amount") - F.lit(mean)))
    holdout = scored.agg(
        F.count(training.RAW_PREDICTION).alias("test_samples"), F.count(F.lit(1)).alias("rows_scored"),
        (F.avg(error) < 1.1 * F.avg(off)).alias("close_to_training_mean"),
    ).withColumn("_one", F.lit(1))
    return sizes.drop("_mean").join(holdout, "_one").select(
        "training_samples", "test_samples", F.lit(len(found.scores)).cast("long").alias("grid_points"),
        "fold_0", "fold_1", "fold_2", "rows_scored", F.lit(found.best == lowest).alias("best_has_lowest_error"),
        "close_to_training_mean",
    )
