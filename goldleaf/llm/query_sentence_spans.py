"""Registered query: repeated sentence spans removed from all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.common import table
from goldleaf.llm.registry import query
from goldleaf.llm.sentence_spans import deduplicated


@query("op2_sentence_spans")
def op2_sentence_spans(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = deduplicated(table(spark, folder, "documents"))
    return cleaned.select(
        F.col("id").alias("doc_id"), "n_sentences", "n_words", "removed_sentences", "removed_words",
        F.md5("clean_text").alias("clean_md5"),
    )
