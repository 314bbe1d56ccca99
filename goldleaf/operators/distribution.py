"""Distributions of columns per group, kept as counts of different values.

Everything after ``value_counts`` works on those counts, so a value that fills a third of the
table is one row. Running totals are taken in two levels (inside a slice of the values, and over
the slices), so no task has to walk all values of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

COLUMN = "column_name"
VALUE = "value"
ROWS = "n"
# Slices per group at least, and values per slice beyond which there are more slices.
SLICES = 64
VALUES_PER_SLICE = 1_000_000


def value_counts(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``by``, column name, value (as double), number of rows. Null values are counted too."""
    numbers = df.select(*by, *(F.col(name).cast("double").alias(name) for name in columns))
    long = numbers.unpivot(list(by), list(columns), COLUMN, VALUE)
    return long.groupBy(*by, COLUMN, VALUE).agg(F.count(F.lit(1)).alias(ROWS))


def running_totals(counts: DataFrame, group: Sequence[str], totals: dict[str, str], slices: int | None = None) -> DataFrame:
    """Add, for each ``count column -> name``, the sum of the count over all values of the group
    up to and including the row's own. Rows are one per (group, value) and values not null.

    Approximate quantiles cut each group into slices of similar size; they only decide who does
    the work, the totals are exact. Without ``slices`` their number grows with the counted rows, so a
    slice stays a task's worth of work; the rows are counted for that, which starts a job.
    """
    if slices is None:
        slices = max(SLICES, counts.count() // VALUES_PER_SLICE)
    steps = [step / slices for step in range(1, slices)]
    cuts = counts.groupBy(*group).agg(F.percentile_approx(VALUE, steps, 1000).alias("_cuts"))
    placed = (
        counts.join(cuts, list(group))
        .withColumn("_slice", F.size(F.filter("_cuts", lambda cut: cut < F.col(VALUE))))
        .drop("_cuts")
    )
    up_to_here = W.partitionBy(*group, "_slice").orderBy(VALUE).rowsBetween(W.unboundedPreceding, W.currentRow)
    slices_before = W.partitionBy(*group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    inside = placed.withColumns({name: F.sum(count).over(up_to_here) for count, name in totals.items()})
    before = (
        placed.groupBy(*group, "_slice")
        .agg(*(F.sum(count).alias(f"_sum_{name}") for count, name in totals.items()))
        .withColumns(
            {
                f"_before_{name}": F.coalesce(F.sum(f"_sum_{name}").over(slices_before), F.lit(0))
                for name in totals.values()
            }
        )
        .drop(*(f"_sum_{name}" for name in totals.values()))
    )
    added = {name: F.col(name) + F.col(f"_before_{name}") for name in totals.values()}
    return inside.join(before, [*group, "_slice"]).select(
        *counts.columns, *(value.alias(name) for name, value in added.items())
    )


def quantiles(counts: DataFrame, group: Sequence[str], shares: dict[str, float]) -> DataFrame:
    """Exact quantiles by nearest rank: the least value that at least the given share of the
    group's non-null rows does not exceed. One row per group with a non-null value."""
    known = counts.filter(F.col(VALUE).isNotNull())
    sizes = known.groupBy(*group).agg(F.sum(ROWS).alias("_size"))
    ranked = running_totals(known, group, {ROWS: "_rank"}).join(sizes, list(group))

    def at(share: float) -> Column:
        return F.min(F.when(F.col("_rank") >= F.ceil(F.col("_size") * share), F.col(VALUE)))

    return ranked.groupBy(*group).agg(*(at(share).alias(name) for name, share in shares.items()))


def profile(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Count, nulls, different values, extremes, mean, standard deviation and quartiles."""
    value, rows = F.col(VALUE), F.col(ROWS)
    known = F.when(value.isNotNull(), rows)
    summary = counts.groupBy(*group).agg(
        F.sum(rows).alias("rows"),
        F.coalesce(F.sum(F.when(value.isNull(), rows)), F.lit(0).cast("long")).alias("nulls"),
        F.count(value).alias("distinct_values"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.try_divide(F.sum(value * rows), F.sum(known)).alias("mean"),
    )
    # squares of distances from the mean: a difference of large squares would lose the spread
    away = value - F.col("mean")
    spread = counts.join(summary.select(*group, "mean"), list(group)).groupBy(*group).agg(
        F.sqrt(F.try_divide(F.sum(away * away * rows), F.sum(known) - 1)).alias("stddev")
    )
    summary = summary.join(spread, list(group))
    quarters = quantiles(counts, group, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return summary.join(quarters, list(group), "left")
