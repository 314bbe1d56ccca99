"""Registered query: periodic runs of words over all documents, a tenth of which are made to repeat themselves."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.common import table
from goldleaf.llm.periodic_runs import periodic_runs
from goldleaf.llm.registry import query


def repeated(words: list[bytes], seed: int) -> list[bytes]:
    """From a place on, which hangs on the seed, the words there are said over and over."""
    n = len(words)
    if not n:
        return words
    after = seed % n
    period = 1 + (n - after) // (3 + seed % 8)
    block = words[after : after + period]
    return words[:after] + (block * ((n - after) // period + 1))[: n - after]


def planted(text: Column, doc_id: Column) -> Column:
    """The text, or for one in ten identifiers a text that repeats itself."""
    checksum = F.crc32(doc_id.cast("string"))
    seed = F.when(checksum % 10 == 0, F.floor(checksum / 10).cast("long"))

    @F.arrow_udf("string")
    def said_again(texts: pa.Array, seeds: pa.Array) -> pa.Array:
        out = texts.to_pylist()
        for place, seed in enumerate(seeds.to_pylist()):
            if seed is not None and out[place]:
                out[place] = b" ".join(repeated(out[place].encode("utf-8").split(), seed)).decode("utf-8")
        return pa.array(out, pa.string())

    return said_again(text, seed)


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    text = planted(F.col("text"), F.col("doc_id"))
    found = table(spark, folder, "documents").select("doc_id", periodic_runs(text, whole=False).alias("found"))
    return found.select(
        "doc_id", "found.n_runs", "found.start", "found.length", "found.period", "found.exponent_milli",
        "found.runs_sha256", "found.collapsed_sha256", "found.n_words",
    )
