"""Registered query: exact deduplication of all documents by streaming state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.common import table
from goldleaf.llm.registry import query
from goldleaf.llm.stream_dedup import classes

SQL = """
WITH prints AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM prints WINDOW same AS (PARTITION BY text_sha256)
"""


@query("op7_stream_dedup", SQL)
def op7_stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = classes(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))
