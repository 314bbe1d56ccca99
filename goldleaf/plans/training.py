"""Training and judging the fare model with Spark ML."""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from goldleaf.functions.measures import ratio
from goldleaf.operators.splitting import row_digest
from goldleaf.schemas import FEATURE_COLUMNS, LABEL
from goldleaf.session import ensure_checkpoints

# The searched grid (trees, depth, learning rate), folds and seed.
PARAMETER_GRID = {"maxIter": (100, 200), "maxDepth": (3, 5, 7), "stepSize": (0.05, 0.1)}
FOLDS = 3
SEED = 42

TREES = "maxIter"
RAW_PREDICTION = "prediction"
FOLD = "_fold"
WEIGHT = "_weight"
BIN = "_bin_"

# What a grid may vary while rows of one cell can be fitted as one weighted row. Anything else (a minimum of rows in a
# leaf, a share of rows for each tree, another loss) tells these rows apart, and such a grid is fitted row by row.
FOLDABLE = {TREES, "maxDepth", "stepSize", "minInfoGain"}
# A feature with more different values than this gets approximate quantiles as bin edges, so that the driver does not
# hold its values; each quantile's rank is within this share of the rows.
MANY_VALUES = 10_000
QUANTILE_ERROR = 0.001
CELLS_PER_TASK = 20_000
# Fits over cells are many stages of few short tasks: this many run side by side, so that the cores are not idle between.
FITS_AT_ONCE = 18


@dataclass(frozen=True)
class SearchResult:
    """The refitted best model and the cross-validated error of every grid point."""

    model: PipelineModel
    best: dict[str, float]
    scores: list[tuple[dict[str, float], float]]


def feature_vector() -> VectorAssembler:
    """Keeps rows with a missing input, so that scoring loses none; see ``apply_model``."""
    return VectorAssembler(inputCols=list(FEATURE_COLUMNS), outputCol="features", handleInvalid="keep")


def all_inputs_known() -> Column:
    return reduce(and_, (F.col(name).isNotNull() for name in FEATURE_COLUMNS))


def apply_model(model: PipelineModel, rows: DataFrame, prediction: str = RAW_PREDICTION) -> DataFrame:
    """Every row with its prediction, null where an input is missing."""
    raw = F.col(RAW_PREDICTION).cast("double")
    return model.transform(rows).select(*rows.columns, F.when(all_inputs_known(), raw).alias(prediction))


def trainable(rows: DataFrame) -> DataFrame:
    """The rows a fit can use: every input and the label known."""
    return rows.where(all_inputs_known() & F.col(LABEL).isNotNull())


def fold_number(columns: Sequence[str], folds: int = FOLDS) -> Column:
    """Which fold a row is in: a digest of the columns, apart from the one that splits off test rows."""
    return (row_digest("fold", columns) % folds).cast("int")


def bin_edges(counts: Sequence[tuple[float, int]], bins: int) -> list[float]:
    """The values up to which a bin goes, from a feature's different values in order, each with its number of rows.

    They lie halfway between neighbouring values: between all of them if the bins suffice, else where the rows so far
    come closest to equal shares. Spark's trees choose their candidate splits so, too.
    """
    halfway = [(low + high) / 2 for (low, _), (high, _) in itertools.pairwise(counts)]
    if len(halfway) < bins:
        return halfway
    share = sum(number for _, number in counts) / bins
    edges, wanted, seen = [], share, 0
    for edge, (_, number), (_, following) in zip(halfway, counts, counts[1:]):
        seen += number
        if abs(seen - wanted) < abs(seen + following - wanted):
            edges.append(edge)
            wanted += share
    return edges


def fold_edges(rows: DataFrame, bins: int, folds: int) -> list[list[list[float]]]:
    """Bin edges of every feature: for the rows outside of fold 0, 1, ..., and last for all rows. NaN has no edge: it
    has a bin of its own above the others."""
    different = rows.agg(*(F.approx_count_distinct(name).alias(name) for name in FEATURE_COLUMNS)).first()
    few = [name for name in FEATURE_COLUMNS if different[name] <= MANY_VALUES]
    values = rows.select(FOLD, F.posexplode(F.array(*few)).alias("_place", "_value")).where(~F.isnan("_value"))
    counted = values.groupBy(FOLD, "_place", "_value").count().collect()
    edges = []
    for fold in [*range(folds), None]:
        numbers = [Counter() for _ in few]
        for row in counted:
            if row[FOLD] != fold:
                numbers[row["_place"]][row["_value"]] += row["count"]
        found = {name: bin_edges(sorted(number.items()), bins) for name, number in zip(few, numbers)}
        many = [name for name in FEATURE_COLUMNS if name not in found]
        if many:
            there = rows if fold is None else rows.where(F.col(FOLD) != fold)
            shares = [place / bins for place in range(1, bins)]
            found |= zip(many, there.approxQuantile(many, shares, QUANTILE_ERROR))
        edges.append([found[name] for name in FEATURE_COLUMNS])
    return edges


def binned_vector(edges: Sequence[Sequence[float]]) -> tuple[Bucketizer, VectorAssembler]:
    """Numbers of bins in place of the features' values, as a vector. A value on an edge is in the lower bin, as it
    goes to the left of a tree's split; a missing one gets no bin below the others, so that scoring loses no row."""
    names = [BIN + name for name in FEATURE_COLUMNS]
    above = [sorted({math.nextafter(edge, math.inf) for edge in some if math.isfinite(edge)}) for some in edges]
    splits = [[-math.inf, *(some or [0.0]), math.inf] for some in above]
    bucketizer = Bucketizer(
        inputCols=list(FEATURE_COLUMNS), outputCols=names, splitsArray=splits, handleInvalid="keep"
    )
    return bucketizer, VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")


def weighted_cells(rows: DataFrame, bucketizer: Bucketizer, assembler: VectorAssembler) -> DataFrame:
    """One row for each combination of bins that occurs: its number of rows as weight, and their mean label.

    A tree that splits between bins gives all rows of a cell one prediction, and with squared loss its choice of splits
    and its leaves hang on counts and sums of labels alone. So boosting on the cells is boosting on the rows. The
    bins bound their number: hours, weekdays and months times the bins of the distance, however many rows there are.
    """
    # without the note a bucketizer leaves on its columns, by which trees would take bins for unordered categories
    bins = [F.col(name).alias(name, metadata={}) for name in bucketizer.getOutputCols()]
    cells = bucketizer.transform(rows).groupBy(*bins).agg(
        F.count(F.lit(1)).cast("double").alias(WEIGHT), F.avg(LABEL).alias(LABEL)
    )
    return assembler.transform(cells).select("features", LABEL, WEIGHT)


def staged_errors(
    fitted: DataFrame, held: DataFrame, trees: GBTRegressor, settings: Mapping[str, float], most: int
) -> list[float]:
    """Mean absolute error on the rows held out with 1, 2, ... ``most`` trees, fitted once on the others.

    Boosting adds trees one after the other, and each hangs only on those before it. So the first n trees of a
    longer fit are the fit with n trees, and one pass over the fold judges all of them.
    """
    estimator = trees.copy({trees.getParam(name): value for name, value in settings.items()})
    errors = estimator.setMaxIter(most).fit(fitted).evaluateEachIteration(held, "absolute")
    return [math.inf if math.isnan(error) else error for error in errors]


def search_fare_model(
    train: DataFrame,
    grid: Mapping[str, Sequence[float]] = PARAMETER_GRID,
    folds: int = FOLDS,
    seed: int = SEED,
    parallelism: int = FITS_AT_ONCE,
    row_id: Sequence[str] = (*FEATURE_COLUMNS, LABEL),
) -> SearchResult:
    """Gradient-boosted trees over the grid, chosen by cross-validated mean absolute error and
    refitted on all training rows. Rows with a missing input or label are left out of the fit.

    Grid points that differ only in the number of trees share their fits: each fold is fitted once with the largest
    number, and the smaller ones are judged as the first trees of that model (``staged_errors``).

    A row's fold is drawn from a digest of ``row_id``, so the winner does not hang on partitioning. The rows stay
    distributed. They are put into bins and counted by cell once for each fold and once as a whole, and the fits go over
    these cells (``weighted_cells``); the errors are those of every row held out. Rows are kept while the search runs;
    give it a stored feature table, so that a lost partition is read again with the same rows.
    """
    spark = train.sparkSession
    ensure_checkpoints(spark)
    trees = GBTRegressor(
        labelCol=LABEL, featuresCol="features", predictionCol=RAW_PREDICTION, weightCol=WEIGHT, seed=seed
    )
    numbers = list(grid.get(TREES, (trees.getMaxIter(),)))
    others = [name for name in grid if name != TREES]
    shared = [dict(zip(others, values)) for values in itertools.product(*(grid[name] for name in others))]
    known = trainable(train).withColumn(FOLD, fold_number(row_id, folds))
    doubles = [F.col(name).cast("double").alias(name) for name in (*FEATURE_COLUMNS, LABEL)]
    kept = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    def estimator_and_rows(part: DataFrame, stages: Sequence[Transformer]) -> tuple[GBTRegressor, DataFrame]:
        if not by_cells:
            return trees, as_vectors(part, stages)
        cells = keep(weighted_cells(part, *stages))
        number = cells.count()
        # splits are looked for among all cells: Spark would take a sample beyond the square of this number
        every = max(trees.getMaxBins(), math.ceil(math.sqrt(number)))
        return trees.copy().setMaxBins(every), cells.coalesce(max(1, math.ceil(number / CELLS_PER_TASK)))

    def as_vectors(part: DataFrame, stages: Sequence[Transformer]) -> DataFrame:
        return PipelineModel([*stages]).transform(part).select("features", LABEL, F.lit(1.0).alias(WEIGHT))

    try:
        rows = keep(known.select(*doubles, FOLD))
        by_cells = FOLDABLE.issuperset(grid)
        if by_cells:
            vectors = [binned_vector(edges) for edges in fold_edges(rows, trees.getMaxBins(), folds)]
        else:
            vectors = [(feature_vector(),)] * (folds + 1)
        inside = [keep(as_vectors(rows.where(F.col(FOLD) == fold), vectors[fold])) for fold in range(folds)]
        outside = [estimator_and_rows(rows.where(F.col(FOLD) != fold), vectors[fold]) for fold in range(folds)]
        with ThreadPoolExecutor(max_workers=parallelism) as workers:
            fit = inheritable_thread_target(spark)(
                lambda work: staged_errors(
                    outside[work[1]][1], inside[work[1]], outside[work[1]][0], work[0], max(numbers)
                )
            )
            stages = list(workers.map(fit, [(settings, fold) for settings in shared for fold in range(folds)]))
        scores = []
        for number in numbers:
            for place, settings in enumerate(shared):
                errors = [stages[place * folds + fold][number - 1] for fold in range(folds)]
                point = {TREES: number, **settings} if TREES in grid else settings
                scores.append(({name: point[name] for name in grid}, sum(errors) / folds))
        best = min(scores, key=lambda score: score[1])[0]
        estimator, everything = estimator_and_rows(rows, vectors[-1])
        model = estimator.copy({trees.getParam(name): value for name, value in best.items()}).fit(everything)
    finally:
        for df in kept:
            df.unpersist()
    return SearchResult(PipelineModel([*vectors[-1], model]), best, scores)


def error_metrics(prediction: Column, label: Column) -> list[Column]:
    """Test MAE, RMSE and R2 as aggregates of one pass over the rows that have a prediction; R2 is
    null when their label never varies."""
    error = prediction.cast("double") - label.cast("double")
    label = F.when(prediction.isNotNull(), label)
    return [
        F.avg(F.abs(error)).alias("test_mae"),
        F.sqrt(F.avg(error * error)).alias("test_rmse"),
        (1 - ratio(F.avg(error * error), F.nullif(F.var_pop(label), F.lit(0.0)))).alias("test_r2"),
    ]


def regression_metrics(scored: DataFrame, prediction: str = RAW_PREDICTION, label: str = LABEL) -> DataFrame:
    return scored.agg(*error_metrics(F.col(prediction), F.col(label)))


def training_run(
    train: DataFrame,
    scored_test: DataFrame,
    dataset: str,
    parameters: Mapping[str, object],
    prediction: str = RAW_PREDICTION,
) -> DataFrame:
    """One row that documents a run: data, sizes, parameters and holdout errors.

    Sizes are those of the rows that were fitted and of the rows that were scored. Two one-row aggregates are laid over each other; append the result to a table of runs.
    """
    sizes = trainable(train).agg(F.count(F.lit(1)).alias("training_samples"))
    holdout = scored_test.agg(
        F.count(prediction).alias("test_samples"), *error_metrics(F.col(prediction), F.col(LABEL))
    )
    measured = ["training_samples", "test_samples", "test_mae", "test_rmse", "test_r2"]
    both = sizes.unionByName(holdout, allowMissingColumns=True)
    chosen = [F.lit(f"{name}={value}") for name, value in parameters.items()]
    return both.agg(*(F.max(name).alias(name) for name in measured)).select(
        F.lit(dataset).alias("dataset"),
        F.lit(",".join(FEATURE_COLUMNS)).alias("feature_columns"),
        F.concat_ws(",", *chosen).alias("parameters"),
        *measured,
    )
