"""Registered query: quality scores of all documents by co-training."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.common import table
from goldleaf.llm.cotraining import quality_scores
from goldleaf.llm.registry import query


@query("op4_cotraining")
def op4_cotraining(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select(
        F.col("id").alias("doc_id"), F.round("text", 6).alias("p_text"), F.round("page", 6).alias("p_page"),
        F.round("both", 6).alias("p_quality"), (F.col("both") >= 0.5).alias("kept"),
    )
