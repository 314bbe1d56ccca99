"""Tables whose row-level changes are kept: what each new version changed goes to a feed beside the table.

The feed of ``<table>`` is ``<table>_changes``, partitioned by ``from_version``, the version that the changes start from. The
new version is complete, but not yet shown, when its changes are written, and writing them again for the same version
replaces them. So a refresh that breaks off anywhere can be repeated, and every shown version has its changes once.
Changes that start from the version a table shows now belong to a version that never appeared; ``pending_changes``
leaves them out.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.operators.audit import INGESTED_AT
from goldleaf.operators.changes import snapshot_changes
from goldleaf.sources.tables import Layout, discarding, overwrite_table, replace_partitions, stored, table_version

FROM_VERSION = "from_version"
REFRESHED_AT = "refreshed_at"
FEED = Layout("What each version changed", {"quality": "feed"}, partition_by=(FROM_VERSION,))


# With more different values than this among the changed rows, whole tables are compared.
MANY_VALUES = 10_000


def _of_changed_values(before: DataFrame, after: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Both sides without the rows of those values of a column whose rows are the same on both.

    Rows are the same when their numbers and the sums of two 64-bit digests of each whole row are. These sums are taken
    on the map side, so only a line per value moves, and what did not change is not dealt by row to be compared.
    """
    columns = after.columns
    # a digest passes over nulls, so where they are belongs to it
    nulls = [F.col(name).isNull() for name in columns]
    digests = [F.xxhash64(F.lit(seed), *columns, *nulls) for seed in (1, 2)]
    # halves of digests: sums of whole ones would overflow
    halves = [half for digest in digests for half in (F.shiftright(digest, 32), digest.bitwiseAND(F.lit(0xFFFFFFFF)))]
    weighed = [
        side.select(column, F.lit(sign).cast("long").alias("_0"), *((half * sign).alias(f"_{k}") for k, half in enumerate(halves, 1)))
        for side, sign in ((before, -1), (after, 1))
    ]
    sums = weighed[0].unionByName(weighed[1]).groupBy(F.col(column).alias("_value")).agg(
        *(F.sum(f"_{k}").alias(f"_{k}") for k in range(len(halves) + 1))
    )
    changed = sums.where(" OR ".join(f"_{k} <> 0" for k in range(len(halves) + 1)))
    values = [row[0] for row in changed.select("_value").limit(MANY_VALUES + 1).collect()]
    if len(values) > MANY_VALUES:
        return before, after
    chosen = F.col(column).isin([value for value in values if value is not None])
    if None in values:
        chosen = F.col(column).isNull() | F.coalesce(chosen, F.lit(False))
    return before.where(chosen), after.where(chosen)


def table_changes(before: DataFrame, after: DataFrame, keys: Sequence[str], gathered_by: str | None = None) -> DataFrame:
    """Row-level changes without the time of ingestion, which every refresh sets anew.

    ``gathered_by`` names a column whose values hold many rows each, say their day; only rows of values with changes are
    compared one by one.
    """
    before, after = before.drop(INGESTED_AT), after.drop(INGESTED_AT)
    if gathered_by is not None and isinstance(after.schema[gathered_by].dataType, (T.DateType, T.IntegralType, T.StringType)):
        before, after = _of_changed_values(before.select(*after.columns), after, gathered_by)
    return snapshot_changes(before, after, keys)


def overwrite_tracked(df: DataFrame, table: str, path: str, layout: Layout, keys: Sequence[str]) -> DataFrame:
    """Replace a table and add to its feed what that changed. The first version changes nothing."""
    spark, now = df.sparkSession, datetime.now(timezone.utc)

    def keep_changes(after: DataFrame) -> None:
        before = spark.read.table(table)
        if sorted(before.columns) != sorted(after.columns):
            raise ValueError(f"{table} is tracked and keeps its columns: {before.columns}, not {after.columns}")
        with discarding(spark):
            changes = stored(table_changes(before, after, keys, next(iter(layout.gather_by), None)), "changes").withColumns(
                {REFRESHED_AT: F.lit(now), FROM_VERSION: F.lit(table_version(spark, table))}
            )
            replace_partitions(changes, f"{table}_changes", f"{path}_changes", FEED)

    return overwrite_table(df, table, path, layout, keep_changes)


def pending_changes(spark: SparkSession, table: str, reflected: str) -> DataFrame | None:
    """What happened to a table since the version ``reflected``; None before anything has."""
    now = table_version(spark, table)
    if now == reflected or not spark.catalog.tableExists(f"{table}_changes"):
        return None
    version = F.col(FROM_VERSION)
    return spark.read.table(f"{table}_changes").where((version >= reflected) & (version < now))
