"""From the log of model calls to one row per prediction, and on to its ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.functions.payload import body_keys, json_values, keyed_records, parse_body
from goldleaf.schemas import FEATURE_COLUMNS, LABEL, PREDICTION, REQUEST_RECORD, RESPONSE_RECORD

# The status of a successful call, and the name of an unnamed model.
SUCCESS = "200"
NO_MODEL = "unknown"

LABEL_COUNT = "label_count"


def normalize_payloads(log: DataFrame) -> DataFrame:
    """The log with both bodies as arrays of typed records. Each step is a projection of its own, so that it runs once per row."""
    bodies = {"request": REQUEST_RECORD, "response": RESPONSE_RECORD}
    parsed = log.withColumns(
        {f"_{name}": parse_body(F.col(name), record) for name, record in bodies.items()}
        | {f"_{name}_values": json_values(F.col(name)) for name in bodies}
    ).withColumns({f"_{name}_keys": body_keys(F.col(f"_{name}_values")) for name in bodies})
    return parsed.withColumns(
        {name: keyed_records(F.col(f"_{name}_keys"), F.col(f"_{name}"), record) for name, record in bodies.items()}
    ).drop(*(f"_{name}{part}" for name in bodies for part in ("", "_values", "_keys")))


def each_record(log: DataFrame, records: Column, position: str, record: str, *columns: str | Column) -> DataFrame:
    """One row per element of an array column, with its place; none for null and empty arrays.

    The plain explode lets Spark filter by the array's size first, below the projections that compute it, which
    computes it twice.
    """
    rows = log.select(*columns, F.posexplode_outer(records).alias(position, record))
    return rows.where(F.col(position).isNotNull())


def paired_records() -> Column:
    """Request i with response i; the shorter side is padded with nulls, and nothing is paired
    when either side could not be read."""
    return F.arrays_zip("request", "response")


def unpack_payloads(log: DataFrame, call_id: Column | None = None) -> DataFrame:
    """One row per prediction of every successful call.

    ``example_id`` is a digest of the call and the position in it, the same on every run. Without
    a ``call_id`` the logged content stands for the call, so two identical log rows share ids.
    """
    if call_id is None:
        call_id = F.sha2(F.concat_ws("|", "request_time", "served_entity_id", "request", "response"), 256)
    answered = log.filter(F.col("status_code") == SUCCESS).withColumn("_call", call_id.cast("string"))
    pairs = each_record(
        normalize_payloads(answered),
        paired_records(),
        "_position",
        "_pair",
        F.col("request_time").cast("timestamp").alias("timestamp"),
        F.col("request_time").cast("date").alias("date"),
        F.coalesce("served_entity_id", F.lit(NO_MODEL)).alias("model_id"),
        "_call",
    )
    return pairs.select(
        "timestamp",
        "date",
        "model_id",
        "_pair.request.*",
        "_pair.response.*",
        F.sha2(F.concat_ws("|", "_call", "_position"), 256).alias("example_id"),
    )


def known_labels(features: DataFrame) -> DataFrame:
    """Each feature vector with each of its labels once, and how often it occurs.

    Logged distances went through a 32-bit float, so the known ones are cut to the same width
    before comparing. Counting equal rows first keeps a frequent trip from flooding the join.
    """
    return (
        features.withColumn("trip_distance", F.col("trip_distance").cast("float"))
        .groupBy(*FEATURE_COLUMNS, LABEL)
        .agg(F.count(F.lit(1)).alias(LABEL_COUNT))
    )


def mean_labels(labels: DataFrame) -> DataFrame:
    """Known labels as one row per feature vector: the mean label and the number of labels."""
    weight = F.col(LABEL_COUNT)
    return labels.groupBy(*FEATURE_COLUMNS).agg(
        (F.sum(F.col(LABEL) * weight) / F.sum(weight)).alias(LABEL), F.sum(weight).alias(LABEL_COUNT)
    )


def join_labels(predictions: DataFrame, labels: DataFrame, every_label: bool = False) -> DataFrame:
    """Predictions beside known labels of their feature vector; null where none is known."""
    chosen = labels if every_label else mean_labels(labels)
    return predictions.join(chosen, list(FEATURE_COLUMNS), "left").select(
        "timestamp", "date", "model_id", *FEATURE_COLUMNS, PREDICTION, "example_id", LABEL, LABEL_COUNT
    )


def join_ground_truth(predictions: DataFrame, features: DataFrame, every_label: bool = False) -> DataFrame:
    """Predictions with the fares of trips that have the same six features.

    Features are no key: a prediction may match several trips. By default it appears once, with
    the mean fare and their number in ``label_count``: the form whose size does not grow with the
    number of trips per vector. With ``every_label`` it appears once per different fare, and
    ``label_count`` says how many trips had that fare (so summing with this weight equals a row per
    matching trip; ``expand_labels`` writes those rows out). Predictions without a match keep a
    null label; null features match nothing.
    """
    return join_labels(predictions, known_labels(features), every_label)


def expand_labels(joined: DataFrame, block: int = 10_000) -> DataFrame:
    """One row per prediction and matching trip, as a plain join would give.

    Copies are written block by block: a frequent label becomes a row per block first, the blocks
    are dealt out, and each task writes one block of copies at a time.
    """
    copies = F.coalesce(F.col(LABEL_COUNT), F.lit(1).cast("long"))
    last = F.floor((copies - 1) / block)
    blocks = joined.withColumn("_copies", copies).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    dealt = blocks.repartition("example_id", "_block")
    size = F.least(F.lit(block).cast("long"), F.col("_copies") - F.col("_block") * block)
    rows = dealt.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), size)))
    return rows.drop("_copy", "_block", "_copies", LABEL_COUNT)


def match_rate(predictions: DataFrame, features: DataFrame) -> DataFrame:
    """One row: how many of the joined rows have a label. Both sides are counted per feature
    vector first, so the join has at most one row per vector on each side."""
    asked = predictions.groupBy(*FEATURE_COLUMNS).agg(F.count(F.lit(1)).alias("_asked"))
    known = known_labels(features).groupBy(*FEATURE_COLUMNS).agg(F.sum(LABEL_COUNT).alias("_known"))
    hits = F.coalesce(F.col("_known"), F.lit(0).cast("long"))
    counted = asked.join(known, list(FEATURE_COLUMNS), "left").agg(
        F.sum(F.col("_asked") * hits).alias("matched"),
        F.sum(F.col("_asked") * F.greatest(hits, F.lit(1).cast("long"))).alias("total"),
    )
    return counted.withColumn("match_rate", F.try_divide("matched", "total"))


def processed_inferences(log: DataFrame, features: DataFrame, call_id: Column | None = None) -> DataFrame:
    """The monitored table: unpacked predictions with their ground truth."""
    return join_ground_truth(unpack_payloads(log, call_id), features)
