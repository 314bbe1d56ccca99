"""Registered query: the ten best documents for each benchmark item."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from goldleaf.llm.block_max_search import build_index, search
from goldleaf.llm.common import Workspace, table
from goldleaf.llm.registry import query

SQL = r"""
WITH texts AS (SELECT row_number() OVER () AS place, doc_id, text FROM documents),
items AS (SELECT row_number() OVER () AS query, item_id, text FROM benchmark),
words AS (
  SELECT place, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM texts),
asked AS (
  SELECT DISTINCT query, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM items),
postings AS (SELECT place, doc_id, term, count(*) AS tf FROM words GROUP BY place, doc_id, term),
lengths AS (SELECT place, sum(tf)::BIGINT AS n FROM postings GROUP BY place),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths),
rarity AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, whole GROUP BY term, docs),
scored AS (
  SELECT query, item_id, place, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN rarity USING (term) JOIN lengths USING (place), whole
  GROUP BY query, item_id, place, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0)
WHERE rank <= 10
"""


@query("op12_block_max_search", SQL)
def op12_block_max_search(spark: SparkSession, folder: str) -> DataFrame:
    index = Workspace(spark, "block-max-index").keep(build_index(table(spark, folder, "documents")), "index")
    return search(index, table(spark, folder, "benchmark"))
