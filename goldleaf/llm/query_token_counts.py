"""Registered query: tokens of all documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.common import table
from goldleaf.llm.registry import query
from goldleaf.llm.token_counts import with_token_counts

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LIMIT = 2048


@query("op13_token_counts")
def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = with_token_counts(table(spark, folder, "documents").select("doc_id", "text"), VOCABULARY)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
