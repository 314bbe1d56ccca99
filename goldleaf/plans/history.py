"""A stored versioned history that batches of changes are added to, late ones too.

The table holds every change with the span it is valid in, deletions included, so that a change that comes after
later ones still finds its place. It is partitioned by a number drawn from the key (``key_part``) and by whether a row is its
key's last (``span``: open or closed). A batch reads only the parts its keys are in; there the spans of its keys are cut again
from their changes, rows of other keys are carried over, and all other parts are neither read nor written. How many parts there are is
fixed when the table is made: choose as many as keep one part a few files large.

A change equal in all columns to one stored already is the same change, so a batch may come twice. An update first lays the
new rows of its parts aside; if it breaks off after that, the next call takes these, so no reader has to stay with half of
an update and nothing is lost. One update at a time. An empty batch changes nothing, and makes no table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.operators.changes import versions_from_changes
from goldleaf.sources.tables import (
    Layout,
    finish_publishing,
    folders,
    overwrite_table,
    remove_folder,
    replace_partitions,
    set_properties,
    table_property,
)

PART, SPAN = "key_part", "span"
SPANS = ["effective_from", "effective_to", "is_current"]
PARTS = 64
PARTS_PROPERTY = "history.key_parts"


@dataclass(frozen=True)
class History:
    """Where a history is kept, and what its changes are keyed and ordered by (see ``versions_from_changes``)."""

    table: str
    path: str
    keys: Sequence[str]
    sequence: Sequence[str]
    bucket: Column
    deleted: str | None = None
    parts: int = PARTS

    def layout(self, parts: int) -> Layout:
        return Layout("Versions of each key", {PARTS_PROPERTY: str(parts)}, partition_by=(PART, SPAN), gather_by=tuple(self.keys))

    @property
    def aside(self) -> str:
        return f"{self.path}/_aside"


def _same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(and_, (F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}")) for key in keys))


def _parts_of(spark: SparkSession, history: History) -> int:
    """As the table was made with."""
    exists = spark.catalog.tableExists(history.table)
    return int(table_property(spark, history.table, PARTS_PROPERTY)) if exists else history.parts


def _in_part(df: DataFrame, history: History, parts: int) -> DataFrame:
    return df.withColumn(PART, F.pmod(F.xxhash64(*history.keys), F.lit(parts)).cast("int"))


def _recut(changes: DataFrame, history: History, parts: int) -> DataFrame:
    versions = versions_from_changes(changes, history.keys, history.sequence, history.bucket)
    return _in_part(versions, history, parts).withColumn(SPAN, F.when(F.col("is_current"), "open").otherwise("closed"))


def finish_update(spark: SparkSession, history: History) -> None:
    """Complete an update that has laid its rows aside, or clear away one that had not come that far."""
    if "_SUCCESS" in folders(spark, history.aside):
        new, layout = spark.read.parquet(history.aside), history.layout(_parts_of(spark, history))
        if spark.catalog.tableExists(history.table):
            replace_partitions(new, history.table, history.path, layout)
            set_properties(spark, history.table, layout.properties)
        else:
            overwrite_table(new, history.table, history.path, layout)
    remove_folder(spark, history.aside)


def apply_batch(batch: DataFrame, history: History) -> list[int]:
    """Add a batch of changes to the history; gives the parts that were written. Which parts they are comes to the driver."""
    spark = batch.sparkSession
    taken = {PART, SPAN, *SPANS} & {name.lower() for name in batch.columns}
    if taken:
        raise ValueError(f"columns that the history adds itself: {sorted(taken)}")
    finish_publishing(spark, history.table)
    finish_update(spark, history)
    parts, columns = _parts_of(spark, history), batch.columns
    placed = _in_part(batch, history, parts)
    touched = sorted(row[PART] for row in placed.select(PART).distinct().collect())
    if not touched:
        return []
    if spark.catalog.tableExists(history.table):
        before = spark.read.table(history.table).where(F.col(PART).isin(touched))
        keys = batch.select(*history.keys).distinct().alias("k")
        same = _same_keys("b", "k", history.keys)
        mine = before.alias("b").join(keys, same, "left_semi").select(*columns)
        others = before.alias("b").join(keys, same, "left_anti")
        versions = _recut(mine.unionByName(batch).distinct(), history, parts)
        new = others.select(*versions.columns).unionByName(versions)
    else:
        new = _recut(batch.distinct(), history, parts)
    new.write.parquet(history.aside)
    finish_update(spark, history)
    return touched


def read_history(spark: SparkSession, history: History) -> DataFrame:
    """All versions; deletions end the one before them and are none themselves."""
    rows = spark.read.table(history.table).drop(PART, SPAN)
    return rows if history.deleted is None else rows.where(~F.coalesce(F.col(history.deleted), F.lit(False)))


def read_current(spark: SparkSession, history: History) -> DataFrame:
    """The version of each key that holds now: the open partitions alone."""
    rows = spark.read.table(history.table).where(F.col(SPAN) == "open").drop(PART, SPAN)
    return rows if history.deleted is None else rows.where(~F.coalesce(F.col(history.deleted), F.lit(False)))
