"""Registered query: near-duplicate classes and links of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.common import table
from goldleaf.llm.lsh_forest import near_classes
from goldleaf.llm.registry import query


@query("op1_lsh_forest")
def op1_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    found = near_classes(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links", "class_size", F.col("first").alias("kept"))
