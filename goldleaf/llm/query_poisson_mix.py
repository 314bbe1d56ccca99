"""Registered query: all documents mixed to target weights per source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.common import table, text_or_empty
from goldleaf.llm.poisson_mix import replicate
from goldleaf.llm.registry import query

# Relative weights; a source that is not named has weight 1.
WEIGHTS = {"src0": 2.0, "src1": 1.5, "src2": 0.5, "src7": 3.0}
SEED = "mix"

SQL = """
WITH RECURSIVE held AS (
  SELECT source, sum(length(coalesce(text, ''))) AS chars,
         CASE source WHEN 'src0' THEN 2.0::DOUBLE WHEN 'src1' THEN 1.5 WHEN 'src2' THEN 0.5 WHEN 'src7' THEN 3.0
              ELSE 1.0 END AS weight
  FROM documents GROUP BY source
),
total AS (SELECT sum(weight) AS weights, sum(chars) AS total FROM held WHERE chars > 0),
rates AS (
  SELECT source, CASE WHEN chars > 0 THEN weight * total * 1.0::DOUBLE / (weights * chars) ELSE 0 END AS rate
  FROM held, total
),
cdf AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM cdf
  WHERE k < ceil(rate + 12 * sqrt(rate) + 40)
),
steps AS (SELECT source, list(c) AS cs FROM cdf GROUP BY source),
drawn AS (
  SELECT doc_id, d.source, md5(coalesce(text, '')) AS text_md5,
         (CAST('0x' || substr(md5('mix:1:' || doc_id), 1, 12) AS BIGINT) + 0.5) / 281474976710656.0::DOUBLE AS u, cs
  FROM documents d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source
),
copies AS (
  SELECT doc_id, source, text_md5, unnest(range(1, len(list_filter(cs, lambda c: c <= u)) + 1)) AS copy FROM drawn
)
SELECT doc_id, source, CAST(copy AS INTEGER) AS copy, md5('mix:order:' || copy || ':' || doc_id) AS shuffle_key, text_md5
FROM copies
"""


@query("op5_poisson_mix", SQL)
def op5_poisson_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = replicate(table(spark, folder, "documents"), WEIGHTS, SEED, columns=["doc_id", "source", "text"])
    # the copies carry their texts through the shuffle; the digest is taken from what arrives
    return mixed.select("doc_id", "source", "copy", "shuffle_key", F.md5(text_or_empty()).alias("text_md5"))
