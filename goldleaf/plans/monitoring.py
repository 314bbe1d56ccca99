"""Daily monitoring of a deployed fare model: volume, quality, profiles and drift.

Volume, profiles and drift look at predictions, one row each, before any ground truth multiplies
them. Profiles and drift work on counts of different values; ``counted_values`` takes them for all columns
in one pass, and the functions named ``..._of`` read them. Functions that store such an intermediate
result start a job when they are called. Drift compares a model's day with its previous day, or with a fixed baseline table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from goldleaf.functions.measures import ratio
from goldleaf.operators import distribution as dist
from goldleaf.operators.distribution import COLUMN, ROWS, VALUE
from goldleaf.plans.inference_log import LABEL_COUNT, known_labels
from goldleaf.schemas import FEATURE_COLUMNS, LABEL, PREDICTION
from goldleaf.sources.tables import stored

GROUP = ["day", "model_id", COLUMN]
NUMERIC = ("trip_distance", PREDICTION)
CATEGORICAL = ("pickup_hour", "pickup_dayofweek", "pickup_month", "is_weekend", "is_rush_hour")

PSI_BINS = 10
# Stands in for an empty share, so that logarithm and division stay defined.
EMPTY_SHARE = 1e-4


def _by_day(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("day", F.to_date("timestamp"))


def volume(predictions: DataFrame) -> DataFrame:
    """Predictions per day and model."""
    return _by_day(predictions).groupBy("day", "model_id").agg(F.count(F.lit(1)).alias("inferences"))


def _exact_sum(value: Column) -> Column:
    """A sum that does not hang on the order of its rows, so that a repeated task moves no figure."""
    return F.sum(value.cast("decimal(38,12)")).cast("double")


def _label_spread(labels: DataFrame) -> DataFrame:
    """Number, mean and squared distances from the mean of the labels of each feature vector."""
    times, label = F.col(LABEL_COUNT), F.col(LABEL).cast("double")
    means = labels.groupBy(*FEATURE_COLUMNS).agg(
        F.sum(times).alias("_labels"), (_exact_sum(times * label) / F.sum(times)).alias("_label_mean")
    )
    away = label - F.col("_label_mean")
    return labels.join(means, list(FEATURE_COLUMNS)).groupBy(*FEATURE_COLUMNS, "_labels", "_label_mean").agg(
        _exact_sum(times * away * away).alias("_label_spread")
    )


def _label_errors(guesses: DataFrame, labels: DataFrame) -> DataFrame:
    """Sums over all labels of a feature vector, per vector and predicted value."""
    label = F.col(LABEL).cast("double")
    error = F.col(PREDICTION).cast("double") - label
    times = F.col(LABEL_COUNT)
    relative = label != 0
    sums = guesses.join(labels, list(FEATURE_COLUMNS)).groupBy(*FEATURE_COLUMNS, PREDICTION).agg(
        _exact_sum(times * F.abs(error)).alias("_abs"),
        _exact_sum(times * error * error).alias("_squares"),
        _exact_sum(F.when(relative, times * F.abs(error) / F.abs(label)).otherwise(0.0)).alias("_relative"),
        F.sum(F.when(relative, times).otherwise(0)).alias("_relative_labels"),
    )
    return sums.join(_label_spread(labels), list(FEATURE_COLUMNS))


def quality(predictions: DataFrame, features: DataFrame) -> DataFrame:
    """Error metrics per day and model over every pair of a prediction and a matching trip.

    The pairs are never written out. A model gives trips with the same features the same fare,
    so the different (features, predicted fare) are few; the error sums over all labels are
    taken once for each of them, and each day's predictions look theirs up and weigh them.
    """
    return quality_against(predictions, known_labels(features))


def quality_against(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """The same with the labels counted already.

    Questions and their errors are read twice (for the sums, and for the distances from the mean
    label), so they are stored, a row per day, model and different question.
    """
    asked = (
        _by_day(predictions)
        .filter(F.col(PREDICTION).isNotNull())
        .groupBy("day", "model_id", *FEATURE_COLUMNS, PREDICTION)
        .agg(F.count(F.lit(1)).alias("_asked"))
    )
    asked = stored(asked, "asked")
    guess = [*FEATURE_COLUMNS, PREDICTION]
    errors = _label_errors(asked.select(*guess).distinct(), labels)
    day = ["day", "model_id"]
    answered = stored(asked.join(errors, guess).drop(*guess), "answered")

    def total(name: str) -> Column:
        return F.sum(F.col("_asked") * F.col(name))

    sums = answered.groupBy(*day).agg(
        total("_labels").alias("labeled"), total("_relative_labels").alias("_relative_labels"),
        *(_exact_sum(F.col("_asked") * F.col(name)).alias(name) for name in ("_abs", "_squares", "_relative")),
        (_exact_sum(F.col("_asked") * F.col("_labels") * F.col("_label_mean")) / total("_labels")).alias("_mean"),
    )
    away = F.col("_label_mean") - F.col("_mean")
    spread = answered.join(sums.select(*day, "_mean"), day).groupBy(*day).agg(
        _exact_sum(F.col("_asked") * (F.col("_label_spread") + F.col("_labels") * away * away)).alias("_spread")
    )
    size = F.col("labeled").cast("double")
    mse = F.col("_squares") / size
    variance = F.col("_spread") / size
    return sums.join(spread, day).select(
        *day,
        "labeled",
        (F.col("_abs") / size).alias("mae"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        ratio(F.col("_relative"), F.col("_relative_labels")).alias("mape"),
        (1 - mse / F.when(variance > 0, variance)).alias("r2"),
    )


def counted_values(predictions: DataFrame, columns: Sequence[str] = (*FEATURE_COLUMNS, PREDICTION)) -> DataFrame:
    """How often each value of each column occurs, per day and model."""
    return dist.value_counts(_by_day(predictions), ["day", "model_id"], columns)


def _stored_counts(predictions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts are read many times below, and are small beside the log they come from, so they are
    stored rather than unpacked anew for each reading."""
    return stored(counted_values(predictions, columns), "value-counts")


def _known(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    return counts.filter(F.col(VALUE).isNotNull() & F.col(COLUMN).isin(*columns))


def profiles(predictions: DataFrame) -> DataFrame:
    """One row per day, model and column (inputs and prediction)."""
    return profiles_of(_stored_counts(predictions, [*FEATURE_COLUMNS, PREDICTION]))


def profiles_of(counts: DataFrame) -> DataFrame:
    return dist.profile(counts, GROUP)


def _compared(counts: DataFrame) -> DataFrame:
    """Counts of each value on a day and on the model's previous day: ``n_now``, ``n_base``, and
    the totals of both. Null values are left to the profiles."""
    sides = _against_previous_day(counts)
    merged = sides.groupBy(*GROUP, VALUE).agg(F.sum("n_now").alias("n_now"), F.sum("n_base").alias("n_base"))
    totals = merged.groupBy(*GROUP).agg(F.sum("n_now").alias("all_now"), F.sum("n_base").alias("all_base"))
    both = totals.filter((F.col("all_now") > 0) & (F.col("all_base") > 0))
    return merged.join(both, GROUP)


def _side(day: Column, now: Column, base: Column) -> list[Column]:
    return [day.alias("day"), F.col("model_id"), F.col(COLUMN), F.col(VALUE), now.alias("n_now"), base.alias("n_base")]


def _against_previous_day(counts: DataFrame) -> DataFrame:
    """Each count serves its own day, and as the base of the model's next day with predictions."""
    nothing = F.lit(0).cast("long")
    days = counts.select("day", "model_id").distinct()
    following = days.withColumn("next_day", F.lead("day").over(W.partitionBy("model_id").orderBy("day")))
    placed = counts.join(following, ["day", "model_id"])
    own = placed.select(*_side(F.col("day"), F.col(ROWS), nothing))
    base = placed.filter(F.col("next_day").isNotNull()).select(*_side(F.col("next_day"), nothing, F.col(ROWS)))
    return own.unionByName(base)


def _share(count: str, total: str) -> Column:
    share = F.col(count) / F.col(total)
    return F.when(share > 0, share).otherwise(F.lit(EMPTY_SHARE))


def _statistic(grouped: DataFrame, name: str) -> DataFrame:
    return grouped.select(*GROUP, F.lit(name).alias("statistic"), F.col(name).alias("drift"))


def _mean(count: str) -> Column:
    return F.sum(F.col(VALUE) * F.col(count)) / F.sum(count)


def _psi_bin() -> Column:
    """Equal-width bins over the base's range; what lies outside falls into the outer bins."""
    position = F.try_divide(F.col(VALUE) - F.col("_low"), F.col("_high") - F.col("_low"))
    binned = F.floor(F.coalesce(position, F.lit(0.0)) * PSI_BINS)
    return F.greatest(F.lit(0), F.least(F.lit(PSI_BINS - 1), binned)).alias("_bin")


def _population_stability(bins: DataFrame) -> DataFrame:
    """From counts per bin. A bin empty on both sides adds nothing and may be missing."""
    now, base = _share("n_now", "all_now"), _share("n_base", "all_base")
    return bins.groupBy(*GROUP).agg(F.sum((now - base) * F.log(now / base)).alias("psi"))


def _numeric_between_days(counts: DataFrame) -> DataFrame:
    compared = stored(_compared(counts), "compared-counts")
    in_base = F.when(F.col("n_base") > 0, F.col(VALUE))
    summary = compared.groupBy(*GROUP).agg(
        (_mean("n_now") - _mean("n_base")).alias("mean_shift"),
        F.min(in_base).alias("_low"),
        F.max(in_base).alias("_high"),
    )
    bins = (
        compared.join(summary.select(*GROUP, "_low", "_high"), GROUP)
        .groupBy(*GROUP, "all_now", "all_base", _psi_bin())
        .agg(F.sum("n_now").alias("n_now"), F.sum("n_base").alias("n_base"))
    )
    totals = dist.running_totals(compared, GROUP, {"n_now": "c_now", "n_base": "c_base"})
    gap = F.abs(F.col("c_now") / F.col("all_now") - F.col("c_base") / F.col("all_base"))
    return (
        _statistic(summary, "mean_shift")
        .unionByName(_statistic(_population_stability(bins), "psi"))
        .unionByName(_statistic(totals.groupBy(*GROUP).agg(F.max(gap).alias("ks")), "ks"))
    )


def _base_counts(baseline: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = stored(dist.value_counts(baseline, [], columns), "baseline-counts")
    return counts.filter(F.col(VALUE).isNotNull()).withColumnRenamed(ROWS, "n_base")


def _numeric_against(counts: DataFrame, base: DataFrame) -> DataFrame:
    """Against one table for all days, without laying its values beside each day's.

    Bins of the base are counted once. For the distance of the distribution functions it is
    enough to look at a day's own values, at the value and just before it: between two of them
    the day's function stands still and the base's only grows. Broadcast are only summaries of
    the base: one row, and at most ten bins, per monitored column.
    """
    now = counts.withColumnRenamed(ROWS, "n_now")
    facts = base.groupBy(COLUMN).agg(
        F.sum("n_base").alias("all_base"),
        _mean("n_base").alias("_base_mean"),
        F.min(VALUE).alias("_low"),
        F.max(VALUE).alias("_high"),
    )
    facts = F.broadcast(facts)
    days = now.groupBy(*GROUP).agg(F.sum("n_now").alias("all_now"), _mean("n_now").alias("_mean")).join(facts, COLUMN)
    shift = days.withColumn("mean_shift", F.col("_mean") - F.col("_base_mean"))

    sizes = days.select(*GROUP, "all_now", "all_base")
    none = F.lit(0).cast("long")
    base_bins = base.join(facts, COLUMN).groupBy(COLUMN, _psi_bin()).agg(F.sum("n_base").alias("n_base"))
    day_bins = now.join(facts, COLUMN).groupBy(*GROUP, _psi_bin()).agg(F.sum("n_now").alias("n_now"))
    bins = (
        sizes.join(F.broadcast(base_bins), COLUMN)
        .select(*GROUP, "_bin", none.alias("n_now"), "n_base")
        .unionByName(day_bins.withColumn("n_base", none))
        .groupBy(*GROUP, "_bin")
        .agg(F.sum("n_now").alias("n_now"), F.sum("n_base").alias("n_base"))
        .join(sizes, GROUP)
    )

    values = base.unionByName(now.select(COLUMN, VALUE).distinct().withColumn("n_base", none))
    points = values.groupBy(COLUMN, VALUE).agg(F.sum("n_base").alias("n_base"))
    base_totals = dist.running_totals(points, [COLUMN], {"n_base": "c_base"})
    day_totals = dist.running_totals(now, GROUP, {"n_now": "c_now"})

    def gap(now_count: Column, base_count: Column) -> Column:
        return F.abs(now_count / F.col("all_now") - base_count / F.col("all_base"))

    here = gap(F.col("c_now"), F.col("c_base"))
    just_before = gap(F.col("c_now") - F.col("n_now"), F.col("c_base") - F.col("n_base"))
    distances = day_totals.join(base_totals, [COLUMN, VALUE]).join(sizes, GROUP)
    return (
        _statistic(shift, "mean_shift")
        .unionByName(_statistic(_population_stability(bins), "psi"))
        .unionByName(_statistic(distances.groupBy(*GROUP).agg(F.max(F.greatest(here, just_before)).alias("ks")), "ks"))
    )


def numeric_drift(
    predictions: DataFrame, baseline: DataFrame | None = None, columns: tuple[str, ...] = NUMERIC
) -> DataFrame:
    """Per day, model and column: shift of the mean, population stability index, and the largest
    distance between the two distribution functions."""
    return numeric_drift_of(_stored_counts(predictions, columns), baseline, columns)


def numeric_drift_of(
    counts: DataFrame, baseline: DataFrame | None = None, columns: tuple[str, ...] = NUMERIC
) -> DataFrame:
    known = _known(counts, columns)
    if baseline is None:
        return _numeric_between_days(known)
    return _numeric_against(known, _base_counts(baseline, columns))


def _with_baseline(counts: DataFrame, base: DataFrame) -> DataFrame:
    """A day's values with how often the base has them, and both totals."""
    now = counts.withColumnRenamed(ROWS, "n_now")
    facts = F.broadcast(base.groupBy(COLUMN).agg(F.sum("n_base").alias("all_base")))  # a row per column
    sizes = now.groupBy(*GROUP).agg(F.sum("n_now").alias("all_now")).join(facts, COLUMN)
    return now.join(base, [COLUMN, VALUE], "left").fillna(0, ["n_base"]).join(sizes, GROUP)


def categorical_drift(
    predictions: DataFrame, baseline: DataFrame | None = None, columns: tuple[str, ...] = CATEGORICAL
) -> DataFrame:
    """Per day, model and column: total variation distance and chi-square against the base.

    Base categories a day lacks add their whole share to both; that share is what the base has
    left after the day's categories.
    """
    return categorical_drift_of(_stored_counts(predictions, columns), baseline, columns)


def categorical_drift_of(
    counts: DataFrame, baseline: DataFrame | None = None, columns: tuple[str, ...] = CATEGORICAL
) -> DataFrame:
    counts = _known(counts, columns)
    compared = _compared(counts) if baseline is None else _with_baseline(counts, _base_counts(baseline, columns))
    now, base = F.col("n_now") / F.col("all_now"), F.col("n_base") / F.col("all_base")
    expected = F.col("all_now") * _share("n_base", "all_base")
    surplus = F.col("n_now") - expected
    unseen = F.col("all_base") - F.col("_seen")
    sums = compared.groupBy(*GROUP, "all_now", "all_base").agg(
        F.sum(F.abs(now - base)).alias("_shift"),
        F.sum(surplus * surplus / expected).alias("_chi"),
        F.sum("n_base").alias("_seen"),
    )
    wide = sums.select(
        *GROUP,
        ((F.col("_shift") + unseen / F.col("all_base")) / 2).alias("total_variation"),
        (F.col("_chi") + F.col("all_now") * (unseen / F.col("all_base"))).alias("chi_square"),
    )
    return wide.unpivot(GROUP, ["total_variation", "chi_square"], "statistic", "drift")
