"""Audit columns added when a source is taken in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INGESTED_AT = "_ingested_at"
SOURCE_TABLE = "_source_table"


def with_audit(df: DataFrame, source_name: str) -> DataFrame:
    """Stamp each row with the start time of the running query and the name of its source."""
    return df.withColumns({INGESTED_AT: F.current_timestamp(), SOURCE_TABLE: F.lit(source_name)})
