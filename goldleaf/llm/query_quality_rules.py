"""Registered query: line-first quality rules over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.common import table
from goldleaf.llm.quality_rules import verdict
from goldleaf.llm.registry import query


@query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = table(spark, folder, "documents").select("doc_id", verdict(F.col("text")).alias("rules"))
    return judged.select(
        "doc_id", "rules.n_words", "rules.word_chars", "rules.n_symbols", "rules.n_dup_lines", "rules.n_repeat_words",
        "rules.base_failed", "rules.kept", "rules.lost_words", "rules.failed_lines",
        F.concat_ws(",", "rules.faults").alias("faults"),
    )
