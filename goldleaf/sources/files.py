"""File readers with explicit schemas, and a JSON writer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines under a given schema: no inference pass, malformed fields become null."""
    return spark.read.schema(schema).json(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, compressed: names are repeated in every line, and files are as many as the tasks that write."""
    df.write.option("compression", "gzip").json(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def stream_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    file_format: str = "json",
    name_pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """An append-only stream over files as they land in a folder."""
    reader = spark.readStream.format(file_format).schema(schema)
    if name_pattern is not None:
        reader = reader.option("pathGlobFilter", name_pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)
