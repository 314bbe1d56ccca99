"""A training-data pipeline over ``documents``: clean, deduplicate, mix, pack.

Each stage gets all rows that the stage before it kept, as stored Parquet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from goldleaf.llm import lsh_forest, poisson_mix, quality_rules, query_poisson_mix, query_residual_packing, stream_dedup
from goldleaf.llm.common import Workspace, free_name, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Failed lines go, and documents that lose too much."""
    return quality_rules.kept_documents(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts the row with the smallest identifier stays."""
    return stream_dedup.kept_documents(docs)


def near_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest identifier."""
    return lsh_forest.kept_documents(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document as often as its source's weight says, in shuffled order."""
    mixed = poisson_mix.replicate(docs, query_poisson_mix.WEIGHTS, query_poisson_mix.SEED)
    return mixed.drop(free_name(docs, "copy"), free_name(docs, "shuffle_key"))


def packing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return query_residual_packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("near duplicates", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
# The stages run Python, streams and iterative joins; tests hold them against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = table(spark, folder, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = work.keep(stage(spark, docs, folder), f"{place}-{name.replace(' ', '-')}")
    return docs
