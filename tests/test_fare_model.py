import uuid
from datetime import datetime

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from goldleaf.functions.calendar import as_flag, is_rush_hour, is_weekend_day
from goldleaf.operators.splitting import split_rows
from goldleaf.plans import champion, fare_jobs, inference_log, scoring, training, trip_features
from goldleaf.queries import QUERIES
from goldleaf.queries.fare_model import fixed_model
from goldleaf.schemas import FEATURE_COLUMNS, LABEL
from goldleaf.session import run_folder
from goldleaf.sources import sample_tables as sample
from tests.test_payloads import KNOWN


def test_weekend_flag(spark):
    flags = spark.range(1, 8).select(as_flag(is_weekend_day(F.col("id")))).collect()
    assert [r[0] for r in flags] == [1, 0, 0, 0, 0, 0, 1]


def test_rush_hour_flag(spark):
    hours = [6, 7, 8, 9, 10, 15, 16, 17, 18, 19, 20, None]
    df = spark.createDataFrame([(k, h) for k, h in enumerate(hours)], "k int, h int").orderBy("k")
    assert [r[0] for r in df.select(as_flag(is_rush_hour(F.col("h")))).collect()] == [0, 1, 1, 1, 0, 0, 1, 1, 1, 1, 0, 0]


TRIPS = "tpep_pickup_datetime timestamp, trip_distance double, fare_amount double"


def test_valid_trips(spark):
    at = datetime(2024, 5, 11, 8)
    offered = [(at, 1.0, fare) for fare in (5.0, 50.0, 150.0, 250.0, 200.0, -5.0, 0.0, None)] + [(at, 0.0, 9.0)]
    kept = trip_features.feature_table(spark.createDataFrame(offered, TRIPS))
    assert kept.columns == [*FEATURE_COLUMNS, LABEL]
    assert sorted(r.fare_amount for r in kept.collect()) == [5.0, 50.0, 150.0]
    first = kept.first()
    assert tuple(first)[1:6] == (8, 7, 5, 1, 1)
    assert dict(kept.dtypes) == {**{name: "int" for name in FEATURE_COLUMNS}, "trip_distance": "double", LABEL: "double"}


def test_null_inputs_are_dropped(spark):
    schema = KNOWN.rsplit(",", 1)[0]
    df = spark.createDataFrame([(1.5, 8, 1, 1, 0, 0), (2.0, 12, 1, 1, 0, 0), (None, 18, 1, 1, 0, 0)], schema)
    assert trip_features.without_null_inputs(df).count() == 2


def test_split_ignores_partitioning(spark):
    df = spark.range(5000).withColumn("x", F.col("id") / 3)
    train, test = split_rows(df, ["id"])
    moved_train, moved_test = split_rows(df.repartition(13), ["id"])
    ids = {r.id for r in test.collect()}
    assert ids == {r.id for r in moved_test.collect()}
    assert train.count() + len(ids) == 5000 and moved_train.count() == train.count()
    assert 0.17 < len(ids) / 5000 < 0.23
    assert {r.id for r in split_rows(df, ["id"], seed=7)[1].collect()} != ids


def rides(spark, pairs):
    return spark.createDataFrame([(float(d), 12, 3, 6, 0, 0, float(fare)) for d, fare in pairs], KNOWN)


SMALL_GRID = {"maxIter": (10,), "maxDepth": (3,), "stepSize": (0.1,)}


@pytest.fixture(scope="module")
def found(spark):
    many = [(d / 4, 3 + 2.5 * d / 4 + d % 3) for d in range(1, 121)]
    return training.search_fare_model(rides(spark, many), {**SMALL_GRID, "maxIter": (2, 10)})


def test_search_keeps_the_best_point(found):
    assert len(found.scores) == 2
    assert found.best == min(found.scores, key=lambda score: score[1])[0]
    assert found.best["maxIter"] == 10


def test_staged_search_is_the_plain_search(spark):
    """Every point fitted by itself, fold by fold, gives the same errors and the same winner."""
    rows = rides(spark, [(d / 4, 3 + 2.5 * d / 4 + (d * 7) % 5) for d in range(1, 161)])
    grid = {"maxIter": (2, 5, 12), "maxDepth": (2, 4), "stepSize": (0.1, 0.4)}
    staged = training.search_fare_model(rows, grid)
    known = training.feature_vector().transform(rows.withColumn("_fold", training.fold_number([*FEATURE_COLUMNS, LABEL])))
    trees = GBTRegressor(labelCol=LABEL, featuresCol="features", seed=training.SEED)
    points = ParamGridBuilder()
    for name, values in grid.items():
        points = points.addGrid(trees.getParam(name), list(values))
    judge = RegressionEvaluator(labelCol=LABEL, metricName="mae")
    plain = CrossValidator(estimator=trees, estimatorParamMaps=points.build(), evaluator=judge, numFolds=3, foldCol="_fold", parallelism=4).fit(known)
    expected = {
        tuple(sorted((param.name, value) for param, value in point.items())): error
        for point, error in zip(plain.getEstimatorParamMaps(), plain.avgMetrics)
    }
    found = {tuple(sorted(point.items())): error for point, error in staged.scores}
    assert found.keys() == expected.keys() and len(found) == 12
    assert all(found[point] == pytest.approx(expected[point], abs=1e-9) for point in expected)
    assert tuple(sorted(staged.best.items())) == min(expected, key=expected.get)
    assert staged.model.stages[-1].getNumTrees == staged.best["maxIter"]


def varied_rides(spark, number):
    """Rides of all hours, weekdays and months; distances hardly repeat, and fares hang on distance and hour."""
    d, hour, day = F.col("id"), F.col("id") * 7 % 24, F.col("id") * 5 % 7 + 1
    distance = (d * 7919 % 10_007) / 331
    fare = 3 + 2.5 * distance + hour / 5 + (d * 6151 % 101) / 17
    columns = [distance, hour, day, d * 11 % 12 + 1, as_flag(is_weekend_day(day)), as_flag(is_rush_hour(hour)), fare]
    return spark.range(1, number + 1).select(*(c.alias(name) for c, name in zip(columns, [*FEATURE_COLUMNS, LABEL])))


def test_fits_do_not_grow_with_the_rows(spark, monkeypatch):
    """However many rows there are, a fit goes over the combinations of bins, each row in one of them."""
    seen, fit = [], GBTRegressor.fit

    def watched(self, dataset, *rest):
        seen.append(dataset)
        assert dataset.count() <= 32 * 2
        return fit(self, dataset, *rest)

    monkeypatch.setattr(GBTRegressor, "fit", watched)
    rows = varied_rides(spark, 4000).withColumns({
        "pickup_hour": F.col("pickup_hour") % 2, "pickup_dayofweek": F.lit(1), "pickup_month": F.lit(1),
        "is_weekend": F.lit(1), "is_rush_hour": F.lit(0),
    })
    grid = {**SMALL_GRID, "maxIter": (1,)}
    training.search_fare_model(rows, grid, folds=2)
    weights = [dataset.agg(F.sum(training.WEIGHT)).first()[0] for dataset in seen]
    assert len(weights) == 3 and weights[0] + weights[1] == weights[2] == 4000


def test_cells_give_the_fit_of_their_rows(spark):
    """A grid that tells the rows of a cell apart is fitted row by row; with values that change nothing it is the same search."""
    rows = varied_rides(spark, 1500).unionAll(varied_rides(spark, 300))
    grid = {"maxIter": (2, 4), "maxDepth": (3,), "stepSize": (0.1, 0.3)}
    by_cells = training.search_fare_model(rows, grid, folds=2)
    by_rows = training.search_fare_model(rows, {**grid, "minInstancesPerNode": (1,)}, folds=2)
    assert [error for _, error in by_cells.scores] == pytest.approx([error for _, error in by_rows.scores], abs=1e-9)
    assert {**by_cells.best, "minInstancesPerNode": 1} == by_rows.best
    both = training.apply_model(by_rows.model, training.apply_model(by_cells.model, rows, "a"), "b")
    assert both.where("a IS NULL OR b IS NULL OR abs(a - b) > 1e-9").isEmpty()


def test_bins_of_a_feature_with_many_values(spark, monkeypatch):
    rows = varied_rides(spark, 2000)
    grid = {"maxIter": (4,), "maxDepth": (5,), "stepSize": (0.3,)}
    (_, exact), = training.search_fare_model(rows, grid, folds=2).scores
    monkeypatch.setattr(training, "MANY_VALUES", 100)
    found = training.search_fare_model(rows, grid, folds=2)
    assert found.scores[0][1] == pytest.approx(exact, rel=0.05)
    assert training.regression_metrics(training.apply_model(found.model, rows)).first().test_r2 > 0.95


def test_a_distance_that_is_no_number_moves_no_bin(spark):
    rows = varied_rides(spark, 400).withColumn("_fold", (F.col("pickup_hour") % 2).cast("int"))
    rows = rows.select(*(F.col(name).cast("double").alias(name) for name in FEATURE_COLUMNS), "_fold")
    odd = rows.unionAll(rows.withColumn("trip_distance", F.lit(float("nan"))))
    edges = [found[0] for found in training.fold_edges(rows, 8, 2)]
    assert [found[0] for found in training.fold_edges(odd, 8, 2)] == edges
    bucketizer, _ = training.binned_vector([edges[-1], *[[]] * 5])
    bins = {r[0] for r in bucketizer.transform(odd).select(training.BIN + "trip_distance").distinct().collect()}
    assert bins == set(range(9))


def test_bin_edges():
    assert training.bin_edges([(1.0, 5), (2.0, 1), (4.0, 1)], 3) == [1.5, 3.0]
    assert training.bin_edges([(float(k), 1) for k in range(8)], 4) == [1.5, 3.5, 5.5]
    assert training.bin_edges([(1.0, 9)], 32) == training.bin_edges([], 32) == []


def test_model_behaves(spark, found):
    asked = rides(spark, [(1, 0), (2, 0), (5, 0), (12, 0), (15, 0)])
    scored = scoring.score_table(asked, found.model, "3")
    assert scored.columns == [*FEATURE_COLUMNS, LABEL, "predicted_fare", "prediction_timestamp", "model_version"]
    by_distance = {r.trip_distance: r.predicted_fare for r in scored.collect()}
    assert len(by_distance) == 5 and all(fare > 0 for fare in by_distance.values())
    assert by_distance[12.0] > by_distance[2.0]
    assert dict(scored.dtypes)["predicted_fare"] == "float"


def test_a_fitted_model_scores_every_row(spark, found):
    asked = spark.createDataFrame([(2.0, 12, 3, 6, 0, 0, 8.0), (2.0, None, None, None, 0, 0, 8.0), (None, 12, 3, 6, 0, 0, 8.0)], KNOWN)
    fares = {(r.trip_distance, r.pickup_hour): r.predicted_fare for r in scoring.score_table(asked, found.model, "1").collect()}
    assert len(fares) == 3 and fares[(2.0, 12)] > 0
    assert fares[(2.0, None)] is None and fares[(None, 12)] is None
    other = scoring.score_with_predictor(asked, lambda: lambda batch: batch["trip_distance"].fillna(1) * 2, "1")
    assert sorted(r.predicted_fare for r in other.collect() if r.predicted_fare is not None) == [4.0]


def test_sizes_are_those_of_fitted_and_scored_rows(spark):
    train = spark.createDataFrame([(2.0, 12, 3, 6, 0, 0, 8.0), (2.0, None, 3, 6, 0, 0, 8.0)], KNOWN)
    row = training.training_run(train, training.apply_model(fixed_model(3.0, 2.5), train), "trips", {}).first()
    assert (row.training_samples, row.test_samples, row.test_mae) == (1, 1, 0.0)


def test_folds_ignore_partitioning(spark):
    df = spark.range(3000)
    folds = {r.id: r.f for r in df.select("id", training.fold_number(["id"]).alias("f")).collect()}
    assert folds == {r.id: r.f for r in df.repartition(11).select("id", training.fold_number(["id"]).alias("f")).collect()}
    assert all(900 < list(folds.values()).count(k) < 1100 for k in range(3))


def test_one_point_of_the_default_grid(spark):
    many = rides(spark, [(d / 4, 3 + 2.5 * d / 4 + d % 3) for d in range(1, 121)])
    grid = {"maxIter": (100,), "maxDepth": (3,), "stepSize": (0.1,)}
    assert all(value in training.PARAMETER_GRID[name] for name, (value,) in grid.items())
    model = training.search_fare_model(many, grid, folds=2).model
    row = training.regression_metrics(training.apply_model(model, many)).first()
    assert row.test_mae < 1.0 and row.test_r2 > 0.95


def test_the_query_searches_the_whole_grid(spark, monkeypatch):
    searched = []

    def search(train, grid=training.PARAMETER_GRID, **rest):
        searched.append(grid)
        points = [({"maxIter": trees}, float(place)) for place, trees in enumerate(grid["maxIter"])]
        return training.SearchResult(fixed_model(3.0, 2.5), points[0][0], points)

    monkeypatch.setattr(training, "search_fare_model", search)
    assert QUERIES["train_fare_model"](spark, "/root/testdata/sf0.001").count() == 1
    assert searched == [{"maxIter": (100, 200), "maxDepth": (3, 5, 7), "stepSize": (0.05, 0.1)}]


def test_model_survives_saving(spark, found, tmp_path):
    found.model.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    asked = rides(spark, [(1, 0), (9, 0)])
    left, right = (scoring.score_table(asked, m, "1").drop("prediction_timestamp") for m in (found.model, again))
    assert left.collect() == right.collect()


def test_predictor_of_another_library(spark):
    asked = rides(spark, [(1, 0), (9, 0)])
    scored = scoring.score_with_predictor(asked, lambda: lambda batch: batch["trip_distance"] * 2 + batch["pickup_hour"], "1")
    assert sorted(r.predicted_fare for r in scored.collect()) == [14.0, 30.0]


def test_metrics_and_run_record(spark):
    test = rides(spark, [(1, 5), (2, 8), (3, 11)])
    scored = fixed_model(3.0, 2.5).transform(test)
    row = training.regression_metrics(scored).first()
    errors = [5.5 - 5, 8 - 8, 10.5 - 11]
    assert row.test_mae == pytest.approx(sum(map(abs, errors)) / 3)
    assert row.test_rmse == pytest.approx((sum(e * e for e in errors) / 3) ** 0.5)
    assert row.test_r2 == pytest.approx(1 - sum(e * e for e in errors) / 18)
    record = training.training_run(rides(spark, [(1, 5)] * 7), scored, "trips", {"maxIter": 10}).collect()
    assert len(record) == 1
    assert (record[0].training_samples, record[0].test_samples, record[0].parameters) == (7, 3, "maxIter=10")
    same = training.regression_metrics(fixed_model(3.0, 2.5).transform(rides(spark, [(1, 5), (2, 5)]))).first()
    assert same.test_r2 is None


@pytest.mark.parametrize(
    "challenger, champion_model, better",
    [((3.0, 2.5), (5.0, 2.5), True), ((5.0, 2.5), (3.0, 2.5), False), ((3.0, 2.5), (3.0, 2.5), False), ((5.0, 2.5), None, True)],
)
def test_champion_gate(spark, challenger, champion_model, better):
    holdout = rides(spark, [(1, 5.5), (2, 8), (4, 13)])
    current = fixed_model(*champion_model) if champion_model else None
    row = champion.compare_models(holdout, fixed_model(*challenger), current).first()
    assert row.is_better is better
    assert (row.champion_mae is None) == (champion_model is None)


def test_gate_without_a_comparison(spark):
    holdout, a, b = rides(spark, [(1, 5.5)]), fixed_model(3.0, 2.5), fixed_model(5.0, 2.5)
    empty = holdout.where("FALSE")
    assert champion.compare_models(empty, a, b).first().is_better is False
    assert champion.compare_models(empty, a).first().is_better is False
    runs = spark.createDataFrame([("a", 2.0)], "run_id string, test_mae double")
    for new, old in (("x", "a"), ("a", "x"), ("x", None)):
        assert champion.compare_logged(runs, new, old).first().is_better is False


def test_gate_on_logged_errors(spark):
    runs = spark.createDataFrame([("a", 2.0), ("b", 1.5), ("c", 2.0)], "run_id string, test_mae double")
    verdict = lambda new, old: champion.compare_logged(runs, new, old).first().is_better
    assert verdict("b", "a") is True and verdict("a", "b") is False
    assert verdict("c", "a") is False and verdict("a", None) is True


def test_train_compare_and_score_as_jobs(spark):
    place = fare_jobs.Place(spark, f"t_{uuid.uuid4().hex[:10]}", run_folder(spark, "test"))
    features = fare_jobs.store_features(place, sample.trips(spark, "/root/testdata/sf0.001"), ["trip_id"])
    assert fare_jobs.champion_run(place) is None
    with pytest.raises(ValueError, match="no champion"):
        fare_jobs.score_features(place)
    first = fare_jobs.train_and_compare(place, "run-1", {**SMALL_GRID, "maxIter": (2,)}, ["trip_id"]).first()
    assert (first.champion_mae, first.is_better) == (None, True)
    same = fare_jobs.train_and_compare(place, "run-2", {**SMALL_GRID, "maxIter": (2,)}, ["trip_id"]).first()
    assert same.champion_mae == first.challenger_mae and same.is_better is False
    assert fare_jobs.champion_run(place) == "run-1"
    scored = fare_jobs.score_features(place)
    assert scored.count() == features.count()
    assert {r.model_version for r in scored.select("model_version").distinct().collect()} == {"run-1"}
    runs = place.read(fare_jobs.RUNS)
    assert runs.count() == 2 and runs.agg(F.max("training_samples")).first()[0] < features.count()
    assert runs.orderBy("run_id").first().test_mae == pytest.approx(first.challenger_mae)


def test_monitoring_job_keeps_one_row_per_prediction(spark):
    small = "/root/testdata/sf0.001"
    log = sample.payload_log(spark, small)
    features = trip_features.feature_table(sample.trips(spark, small))
    made = {}
    for every_label in (False, True):
        place = fare_jobs.Place(spark, f"t_{uuid.uuid4().hex[:10]}", run_folder(spark, "test"))
        made[every_label] = fare_jobs.refresh_monitoring(place, log, features, F.col("request_id"), every_label=every_label)
    lean, full = made[False], made[True]
    assert lean["inference_processed"].count() == lean["inferences"].count()
    rebuilt = inference_log.join_labels(lean["inferences"], lean["known_labels"], every_label=True)
    assert rebuilt.exceptAll(full["inference_processed"]).count() == 0
    assert full["inference_processed"].count() == rebuilt.count()
    for name in lean:
        if name.startswith("monitor_"):
            assert lean[name].exceptAll(full[name]).count() == 0
