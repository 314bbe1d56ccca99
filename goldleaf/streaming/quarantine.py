"""Streamed rows held against quality rules: good rows, a quarantine that tells which rules were violated, and rule counts.

Every batch is computed once and written in one go below a folder of its own, good rows and quarantined ones together;
the counts of its rules are then taken from what is stored. Both are replaced when Spark hands the batch on again after a
failure, so a repeated batch changes nothing. A rule that comes out NULL is violated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from goldleaf.operators.expectations import Rules, violated_rules

VIOLATED, VERDICT, BATCH = "violated_rules", "verdict", "batch_id"
GOOD, BAD = "good", "quarantined"
COUNTS = f"rule string, passed long, failed long, {BATCH} long"


def _checked_schema(schema: T.StructType) -> T.StructType:
    added = T.StructType().add(VIOLATED, T.ArrayType(T.StringType())).add(BATCH, T.LongType()).add(VERDICT, T.StringType())
    return T.StructType([*schema.fields, *added.fields])


def _checked(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(_checked_schema(schema)).option("basePath", f"{folder}/checked").parquet(f"{folder}/checked")


def write_rows(batch: DataFrame, batch_id: int, folder: str, rules: Rules) -> None:
    checked = batch.withColumn(VIOLATED, violated_rules(rules))
    checked = checked.withColumn(VERDICT, F.when(F.size(VIOLATED) == 0, GOOD).otherwise(BAD))
    checked.write.mode("overwrite").partitionBy(VERDICT).parquet(f"{folder}/checked/{BATCH}={batch_id}")


def write_counts(spark: SparkSession, schema: T.StructType, batch_id: int, folder: str, rules: Rules) -> None:
    """A line per rule, from the stored lists of violated rules alone."""
    rows = _checked(spark, folder, schema).where(F.col(BATCH) == batch_id)
    failed = [F.count_if(F.array_contains(VIOLATED, rule)).alias(rule) for rule in rules]
    totals = rows.agg(F.count(F.lit(1)).alias("_rows"), *failed)
    lines = [
        F.struct(F.lit(rule).alias("rule"), (F.col("_rows") - F.col(rule)).alias("passed"), F.col(rule).alias("failed"))
        for rule in rules
    ]
    counts = totals.select(F.inline(F.array(*lines)))
    counts.write.mode("overwrite").parquet(f"{folder}/counts/{BATCH}={batch_id}")


def append_checked(
    stream: DataFrame, steps: Callable[[DataFrame], DataFrame], rules: Rules, folder: str, checkpoint: str
) -> StreamingQuery:
    """Take in everything that has landed since the last run, then stop. Folder and checkpoint belong together."""
    ready = steps(stream)
    taken = {VIOLATED, VERDICT, BATCH} & {name.lower() for name in ready.columns}
    if taken:
        raise ValueError(f"columns that the quarantine adds itself: {sorted(taken)}")
    schema = ready.schema

    def take(batch: DataFrame, batch_id: int) -> None:
        write_rows(batch, batch_id, folder, rules)
        write_counts(batch.sparkSession, schema, batch_id, folder, rules)

    return ready.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def good_rows(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Rows that hold all rules; the other partitions are not read."""
    return _checked(spark, folder, schema).where(F.col(VERDICT) == GOOD).drop(VIOLATED, VERDICT, BATCH)


def quarantined_rows(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Rows that violate a rule, with the names of the rules and the batch they came in."""
    return _checked(spark, folder, schema).where(F.col(VERDICT) == BAD).drop(VERDICT)


def rule_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Passed and failed rows per rule and batch."""
    return spark.read.schema(COUNTS).parquet(f"{folder}/counts")
