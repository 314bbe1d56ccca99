"""Writing datasets as catalog tables: layout, comment, properties.

A table is parquet below a folder of its own. Every overwrite goes to a new version folder there, and only when that is
complete does the catalog point to it, rows and schema together: readers see the old version or the new one, and
a write that fails changes nothing. The version before stays for readers that have started on it; older ones
are removed. Tables partitioned by day can have single partitions replaced.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from goldleaf.session import run_folder


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def create_schema(spark: SparkSession, schema: str, folder: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION {_quoted(folder)}")


def set_properties(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    pairs = ", ".join(f"{_quoted(key)} = {_quoted(value)}" for key, value in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def gathered_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring equal values together for columns whose values repeat.

    Each value lands in few files, sorted, so a filter on it skips the other files and row groups
    by their min/max. The rebalance lets adaptive execution split a value that holds a large part
    of the rows into several files, and merge small ones.
    """
    return df.hint("rebalance", *columns).sortWithinPartitions(*columns)


def ranged_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Order the whole table by columns that identify a row (no value repeats much).

    Spark samples the input to find the range bounds, which reads the input's last stage twice;
    after an aggregate that means its shuffled output, not the scan below it.
    """
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


@dataclass(frozen=True)
class Layout:
    """How a dataset lies on disk and what the catalog says about it."""

    comment: str = ""
    properties: Mapping[str, str] = field(default_factory=dict)
    partition_by: Sequence[str] = ()
    gather_by: Sequence[str] = ()
    range_by: Sequence[str] = ()
    # the dataset comes as the layout asks, and is written as it comes
    as_it_comes: bool = False


def arranged(df: DataFrame, layout: Layout) -> DataFrame:
    if layout.as_it_comes:
        return df
    if layout.partition_by:
        spread = df.hint("rebalance", *layout.partition_by)
        inner = [*layout.gather_by, *layout.range_by]
        return spread.sortWithinPartitions(*layout.partition_by, *inner)
    if layout.gather_by:
        return gathered_by(df, layout.gather_by)
    if layout.range_by:
        return ranged_by(df, layout.range_by)
    return df


# Fixed value: how tables are compressed.
COMPRESSION = "zstd"
VERSION = "version-"
# Versions that stay below a table's folder: the current one and the one before.
KEPT_VERSIONS = 2


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE EXTENDED {table}")
    return described.where("col_name = 'Location'").first()["data_type"]


def table_version(spark: SparkSession, table: str) -> str:
    """The name of the version that a table shows now; later versions sort after earlier ones."""
    return table_location(spark, table).rstrip("/").rsplit("/", 1)[-1]


def _described(spark: SparkSession, table: str, layout: Layout) -> None:
    if layout.comment:
        spark.sql(f"COMMENT ON TABLE {table} IS {_quoted(layout.comment)}")
    if layout.properties:
        set_properties(spark, table, layout.properties)


def _same_columns(left: DataFrame, right: DataFrame) -> bool:
    return [(f.name, f.dataType) for f in left.schema] == [(f.name, f.dataType) for f in right.schema]


def finish_publishing(spark: SparkSession, table: str) -> None:
    """Complete, or clear away, what an overwrite that was broken off has left in the catalog."""
    if not spark.catalog.tableExists(f"{table}__next"):
        return
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE {table}__next")
    else:
        spark.sql(f"ALTER TABLE {table}__next RENAME TO {table}")


def overwrite_table(
    df: DataFrame,
    table: str,
    path: str,
    layout: Layout = Layout(),
    before_publishing: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Replace a table with the rows and columns of ``df``, which may read the table itself, and return it.

    The rows go to a new folder below ``path``. An unpartitioned table that keeps its columns is then pointed there
    in one catalog step. Otherwise the new version is registered beside the table and takes its name;
    ``finish_publishing`` ends that if the driver is lost between the two steps. ``before_publishing`` sees the complete
    new version while the table still shows the old one, and stops the replacement by raising.
    """
    spark = df.sparkSession
    finish_publishing(spark, table)
    place = f"{path}/{VERSION}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    exists = spark.catalog.tableExists(table)
    beside = exists and (bool(layout.partition_by) or not _same_columns(df, spark.read.table(table)))
    name = f"{table}__next" if beside else table
    try:
        writer = arranged(df, layout).write.format("parquet").option("compression", COMPRESSION)
        if exists and not beside:
            writer.save(place)
            new = spark.read.schema(df.schema).parquet(place)
        else:
            if layout.partition_by:
                writer = writer.partitionBy(*layout.partition_by)
            writer.option("path", place).saveAsTable(name)
            _described(spark, name, layout)
            new = spark.read.table(name)
        if exists and before_publishing is not None:
            before_publishing(new)
        if beside:
            spark.sql(f"DROP TABLE {table}")
            spark.sql(f"ALTER TABLE {name} RENAME TO {table}")
        elif exists:
            spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(place)}")
            _described(spark, table, layout)
    except Exception:
        if spark.catalog.tableExists(table):
            if beside:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            if table_version(spark, table) != place.rsplit("/", 1)[-1]:
                remove_folder(spark, place)
        raise
    _remove_old_versions(spark, table, path)
    return spark.read.table(table)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies below a path; nothing where the path does not exist."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return [entry.getPath().getName() for entry in system.listStatus(where)] if system.exists(where) else []


def _remove_old_versions(spark: SparkSession, table: str, path: str) -> None:
    """Versions before the current one, but for the last of them. Later ones may be under way."""
    current = table_version(spark, table)
    before = sorted(name for name in folders(spark, path) if name.startswith(VERSION) and name < current)
    for name in before[: len(before) - (KEPT_VERSIONS - 1)]:
        remove_folder(spark, f"{path}/{name}")


def _partition(columns: Sequence[str], row: Row) -> str:
    values = ("NULL" if row[name] is None else _quoted(str(row[name])) for name in columns)
    return "PARTITION (" + ", ".join(f"{name} = {value}" for name, value in zip(columns, values)) + ")"


def replace_partitions(df: DataFrame, table: str, path: str, layout: Layout, gone: DataFrame | None = None) -> DataFrame:
    """Replace those partitions of a table that ``df`` has rows of, and remove those that ``gone`` names.

    Other partitions are neither read nor written. The partitions replaced become visible one by one when all are written;
    doing the same again gives the same table. The list of partitions comes to the driver. A table that
    does not exist yet is created. ``df`` must be stored: it is read twice, and must not read the table itself.
    """
    spark, keys = df.sparkSession, list(layout.partition_by)
    finish_publishing(spark, table)
    if not spark.catalog.tableExists(table):
        return overwrite_table(df, table, path, layout)
    place = table_location(spark, table)
    writer = arranged(df, layout).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(place)
    written = df.select(*keys).distinct().collect()
    if written:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(_partition(keys, row) for row in written)}")
    for row in gone.select(*keys).distinct().collect() if gone is not None else []:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_partition(keys, row)}")
        parts = (f"{key}={'__HIVE_DEFAULT_PARTITION__' if row[key] is None else row[key]}" for key in keys)
        remove_folder(spark, "/".join([place, *parts]))
    spark.sql(f"REFRESH TABLE {table}")
    return spark.read.table(table)


def table_property(spark: SparkSession, table: str, key: str) -> str | None:
    found = [row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if row["key"] == key]
    return found[0] if found else None


def append_table(df: DataFrame, table: str, path: str) -> DataFrame:
    """Add rows to a table of the same columns, creating it the first time."""
    writer = df.write.format("parquet").mode("append")
    if not df.sparkSession.catalog.tableExists(table):
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.read.table(table)


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows read back from a new folder in the shared space.

    For an intermediate result that several later steps read: it is computed once, its plan ends
    there, and it outlives the executors that computed it. Inside ``discarding`` the folder is removed
    at the end; elsewhere it belongs to the caller, as a plan that is still to run may read it.
    """
    folder = run_folder(df.sparkSession, label)
    df.write.option("compression", COMPRESSION).parquet(folder)
    made = _made.get()
    if made is not None:
        made.append(folder)
    return df.sparkSession.read.parquet(folder)


def remove_folder(spark: SparkSession, folder: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def discarding(spark: SparkSession) -> Iterator[None]:
    """Remove what ``stored`` has made inside the block. Results must be stored elsewhere by then."""
    folders: list[str] = []
    token = _made.set(folders)
    try:
        yield
    finally:
        _made.reset(token)
        for folder in folders:
            remove_folder(spark, folder)
