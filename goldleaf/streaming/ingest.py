"""Take in files as they land, exactly once, through the same steps as the batch layers.

Only row-wise steps and joins with static tables run in the stream, so it keeps no state: the
checkpoint holds just the list of files already taken in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from goldleaf.plans import bronze, silver


def to_silver_transactions(stream: DataFrame) -> DataFrame:
    """Audit, clean and check streamed sales; one definition for batch and stream."""
    return silver.silver_transactions(bronze.bronze_transactions(stream))


def append_available(
    stream: DataFrame,
    steps: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append everything that has landed since the last run, then stop.

    Target and checkpoint belong together: run again with the same pair to continue. The target's
    write log keeps files of a broken attempt out of later reads.
    """
    writer = (
        steps(stream)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(target)


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an available-now run; an error inside the stream is raised here."""
    query.awaitTermination()
