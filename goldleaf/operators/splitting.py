"""A train/test split that depends on the rows alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 10_000


def row_digest(seed: object, columns: Sequence[str]) -> Column:
    """32 bits of a digest of the seed and the named columns."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(name).cast("string"), F.lit("")) for name in columns))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def split_bucket(columns: Sequence[str], seed: int = 42) -> Column:
    """A number below ``BUCKETS`` drawn from a digest of the seed and the named columns."""
    return row_digest(seed, columns) % BUCKETS


def split_rows(
    df: DataFrame, columns: Sequence[str], test_share: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows. The same row falls on the same side whatever the partitioning and
    however often a task is repeated.

    Rows equal in ``columns`` go to one side together; name a row id among them if rows repeat.
    """
    for_training = split_bucket(columns, seed) >= round(test_share * BUCKETS)
    return df.filter(for_training), df.filter(~for_training)
