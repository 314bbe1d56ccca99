"""Registered query: all pages against dated URL lists.

The tables hold no fetch times and no lists. Both are derived from ``pages``: a page's fetch time hangs on
its identifier, and every host, domain or path prefix of the pages whose digest begins with 0 to 2 (and all that
name spam or adult sites) is on a list, with one to four dated events that hang on its digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.common import table
from goldleaf.llm.registry import query
from goldleaf.llm.temporal_lists import judged, url_keys


def number(text: Column) -> Column:
    """28 bits of a text's digest."""
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")


def page_captures(spark: SparkSession, folder: str) -> DataFrame:
    hours = F.pmod(number(F.concat(F.lit("fetch "), F.col("page_id").cast("string"))), F.lit(366 * 24)).cast("int")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return table(spark, folder, "pages").select("page_id", "url", (start + F.make_dt_interval(hours=hours)).alias("at"))


def list_events(captures: DataFrame) -> DataFrame:
    """list, verdict, key, day, action, seq."""
    keys = captures.select(F.explode(url_keys(F.col("url"))).alias("key")).distinct()
    bad = F.col("key").rlike("spam|adult")
    listed = keys.where(bad | F.substring(F.md5("key"), 1, 1).isin("0", "1", "2"))
    changes = listed.withColumn("seq", F.explode(F.sequence(F.lit(0), F.pmod(number(F.col("key")), F.lit(4)).cast("int"))))
    draw = number(F.concat_ws(" ", F.col("seq").cast("string"), F.col("key")))
    day = F.date_add(F.lit("2023-12-01").cast("date"), F.pmod(draw, F.lit(390)).cast("int")).cast("timestamp_ntz")
    verdict = F.when(bad | (F.pmod(number(F.concat(F.lit("list "), F.col("key"))), F.lit(3)) > 0), "block").otherwise("allow")
    return changes.select(
        F.when(bad, "unsafe").when(verdict == "block", "reported").otherwise("trusted").alias("list"), verdict.alias("verdict"),
        "key", day.alias("day"), F.when(F.pmod(draw, F.lit(5)) < 3, "add").otherwise("remove").alias("action"), "seq",
    )


SQL = """
WITH captures AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01'
           + to_hours(CAST(CAST('0x' || substr(md5('fetch ' || page_id), 1, 7) AS BIGINT) % (366 * 24) AS INTEGER)) AS fetched,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
parts AS (
  SELECT *, string_split(host, '.') AS labels, list_filter(string_split(path, '/'), lambda x: x <> '') AS steps
  FROM captures WHERE host <> ''
),
wanted AS (
  SELECT DISTINCT page_id, fetched, unnest(
           ['host:' || host]
           || list_transform(range(1, len(labels)), lambda i: 'domain:' || array_to_string(labels[i:], '.'))
           || list_transform(range(1, len(steps) + 1), lambda i: 'prefix:' || host || '/' || array_to_string(steps[:i], '/'))
         ) AS key
  FROM parts
),
listed AS (
  SELECT DISTINCT key, regexp_matches(key, 'spam|adult') AS bad FROM wanted
  WHERE regexp_matches(key, 'spam|adult') OR substr(md5(key), 1, 1) IN ('0', '1', '2')
),
changes AS (
  SELECT key, bad, unnest(range(0, CAST('0x' || substr(md5(key), 1, 7) AS BIGINT) % 4 + 1)) AS seq FROM listed
),
drawn AS (
  SELECT *, CAST('0x' || substr(md5(seq || ' ' || key), 1, 7) AS BIGINT) AS draw,
         CASE WHEN bad OR CAST('0x' || substr(md5('list ' || key), 1, 7) AS BIGINT) % 3 > 0 THEN 'block' ELSE 'allow' END
           AS verdict
  FROM changes
),
events AS (
  SELECT key, verdict, seq, DATE '2023-12-01' + CAST(draw % 390 AS INTEGER) AS day, draw % 5 < 3 AS added FROM drawn
),
daily AS (
  SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY key, day ORDER BY seq DESC) = 1
),
spans AS (
  SELECT key, verdict, added, day AS valid_from, lead(day) OVER (PARTITION BY key ORDER BY day) AS valid_to FROM daily
),
active AS (
  SELECT page_id, w.key, verdict,
         CASE split_part(w.key, ':', 1) WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 ELSE 1 END AS rank
  FROM wanted w JOIN spans s ON w.key = s.key AND added AND fetched >= valid_from AND (valid_to IS NULL OR fetched < valid_to)
),
best AS (
  SELECT page_id, count(*) OVER (PARTITION BY page_id) AS n_active, verdict, key FROM active
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY rank DESC, length(key) DESC, verdict = 'block' DESC, key DESC) = 1
)
SELECT c.page_id, CASE WHEN host <> '' THEN host END AS host, fetched AS fetch_time, coalesce(n_active, 0) AS n_active,
       coalesce(verdict, 'none') AS decision, b.key AS matched, coalesce(verdict, 'none') <> 'block' AS kept
FROM captures c LEFT JOIN best b ON c.page_id = b.page_id
"""


@query("op3_temporal_lists", SQL)
def op3_temporal_lists(spark: SparkSession, folder: str) -> DataFrame:
    captures = page_captures(spark, folder)
    found = judged(captures, list_events(captures), "page_id", "url", "at")
    return found.select(
        F.col("id").alias("page_id"), "host", F.col("at").alias("fetch_time"), "n_active", "decision", "matched",
        (F.col("decision") != "block").alias("kept"),
    )
