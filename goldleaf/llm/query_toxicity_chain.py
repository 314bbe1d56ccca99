"""Registered query: toxicity of all documents by a classifier chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.common import table
from goldleaf.llm.registry import query
from goldleaf.llm.toxicity_chain import scores, train


@query("op9_toxicity_chain")
def op9_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    chain = train(docs, table(spark, folder, "labels"))
    scored = docs.select("doc_id", scores(F.col("text"), chain).alias("s"))
    return scored.select(
        "doc_id", *(F.round(F.col("s")[name], 6).alias(f"p_{name}") for name in chain.names), F.col("s.flagged").alias("toxic")
    )
