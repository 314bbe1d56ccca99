"""Row-level changes between two snapshots, and versioned history from a change list."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHANGE_TYPE = "change_type"
COPIES = "copies"
# Parts of a large bucket.
SLICES = 64


def snapshot_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What turned one snapshot of a table into the next, in change-feed form.

    Gives ``insert`` and ``delete`` rows, and for a key with rows on both sides
    ``update_preimage`` and ``update_postimage``; ``copies`` says how often a row came or went.

    Equal rows cancel out in one aggregate, already partly on the map side, so unchanged rows
    are never joined and repeated rows or keys multiply nothing. Only the changed keys are
    looked up afterwards.
    """
    columns = after.columns
    counted = before.select(*columns, F.lit(-1).alias(COPIES)).unionByName(
        after.select(*columns, F.lit(1).alias(COPIES))
    )
    changed = counted.groupBy(*columns).agg(F.sum(COPIES).alias(COPIES)).filter(F.col(COPIES) != 0)
    sides = changed.groupBy(*(F.col(key).alias(f"_{key}") for key in keys)).agg(
        ((F.min(COPIES) < 0) & (F.max(COPIES) > 0)).alias("_both")
    )
    same_key = reduce(and_, (F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys))
    gone = F.col(COPIES) < 0
    kind = (
        F.when(F.col("_both") & gone, "update_preimage")
        .when(F.col("_both"), "update_postimage")
        .when(gone, "delete")
        .otherwise("insert")
    )
    return changed.join(sides, same_key).select(
        *columns, kind.alias(CHANGE_TYPE), F.abs(COPIES).alias(COPIES)
    )


def _slice_of_bucket(placed: DataFrame, keys: Sequence[str], first: str, rows_per_slice: int) -> DataFrame:
    """Add ``_slice``: which part of its bucket a change is in, 0 where the bucket is small.

    Approximate quantiles of the sequence's first column cut large buckets; changes of one value stay
    together, so slices follow the order of the sequence.
    """
    kind = placed.schema[first].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return placed.withColumn("_slice", F.lit(0))
    value = F.col(first).cast("timestamp") if isinstance(kind, T.TimestampNTZType) else F.col(first)
    steps = [step / SLICES for step in range(1, SLICES)]
    large = (
        placed.groupBy(*(F.col(key).alias(f"_{key}") for key in keys), F.col("_bucket").alias("_large"))
        .agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx(value, steps, 1000).alias("_cuts"))
        .filter(F.col("_n") > rows_per_slice)
    )
    same = reduce(and_, (F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys), F.col("_bucket").eqNullSafe(F.col("_large")))
    before = F.size(F.filter("_cuts", lambda cut: cut < value))
    cut = placed.join(large, same, "left").withColumn("_slice", F.when(F.col("_cuts").isNull(), 0).otherwise(before))
    return cut.select(*placed.columns, "_slice")


def versions_from_changes(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    bucket: Column,
    deleted: Column | None = None,
    rows_per_slice: int = 1_000_000,
) -> DataFrame:
    """Versioned history (slowly changing dimension, type 2): one row per change with the span
    it was valid in, from its own position to that of the key's next change.

    ``sequence`` orders the changes of a key; its first column becomes the span's bounds.
    ``bucket`` must not decrease along the sequence (a month of a date, say). The next change is
    looked up inside a bucket first and across buckets second, and buckets of more than
    ``rows_per_slice`` changes of one key are cut once more, so a key with very many changes
    is worked on by many tasks. Changes without a key belong to one key of their own. Rows where
    ``deleted`` holds end the version before them and open none.
    """
    position = F.struct(*sequence)
    placed = changes.withColumns({"_bucket": bucket, "_at": position})
    placed = _slice_of_bucket(placed, keys, sequence[0], rows_per_slice)
    part = [*keys, "_bucket", "_slice"]
    inside = W.partitionBy(*part).orderBy("_at")
    across = W.partitionBy(*keys).orderBy("_bucket", "_slice")
    followed = placed.withColumn("_next", F.lead("_at").over(inside))
    openings = (
        placed.groupBy(*part)
        .agg(F.min("_at").alias("_first"))
        .withColumn("_later", F.lead("_first").over(across))
        .select(*(F.col(name).alias(f"_of_{name}") for name in part), "_later")
    )
    same_part = reduce(and_, (F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in part))
    until = F.coalesce("_next", "_later")[sequence[0]]
    history = followed.join(openings, same_part).withColumns(
        {
            "effective_from": F.col(sequence[0]),
            "effective_to": until,
            "is_current": F.coalesce("_next", "_later").isNull(),
        }
    )
    if deleted is not None:
        history = history.filter(~F.coalesce(deleted, F.lit(False)))
    return history.select(*changes.columns, "effective_from", "effective_to", "is_current")
