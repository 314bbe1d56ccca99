"""Registered query: all documents packed into sequences of 2048 tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.common import table
from goldleaf.llm.registry import query
from goldleaf.llm.residual_packing import pack

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def packed(docs: DataFrame) -> DataFrame:
    return pack(docs, VOCABULARY, RANKS).select(
        F.col("id").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"),
        F.col("sequence").alias("sequence_id"), "offset",
    )


@query("op8_residual_packing")
def op8_residual_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))
