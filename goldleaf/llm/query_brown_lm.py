"""Registered query: class-based language-model scores of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.brown_lm import scores
from goldleaf.llm.common import table
from goldleaf.llm.registry import query


@query("op6_brown_lm")
def op6_brown_lm(spark: SparkSession, folder: str) -> DataFrame:
    # the part that is held out; rows without identifier train
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    found = scores(table(spark, folder, "documents"), ~held_out)
    return found.select(
        F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"
    )
