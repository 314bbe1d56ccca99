"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate: its share of the target, in characters, over what it has.
A document is repeated as often as a Poisson distribution of that mean says at a uniform number that
hangs on a seed and the document's identifier alone: the count is the number of cumulative
probabilities at or below the number. Copies are then dealt out by a hash, and each partition is sorted
by it, so rows of all sources lie in random order over all partitions.

* Weights are relative; a source without a weight has ``other_weight``. Sources whose texts hold no
  character at all get rate 0. Null sources are one source of their own.
* Null text counts as empty. Rows with the same identifier (or none) and the same text get the same count.
* Counts have no upper bound. A mean over ``LARGEST_MEAN`` is taken as the sum of several independent
  counts of equal smaller means, because its probability of zero would be too small for a double.
* An empty table gives an empty result. Columns of any name pass through.

Built-in functions only; sources are few, so their rates are a small table, which Spark broadcasts when
its stored size is below the session's threshold and joins by shuffle otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import Workspace, free_name, text_or_empty

LARGEST_MEAN = 500.0
# hexadecimal digits of the hash that make the uniform number
DIGITS = 12


def uniform(*parts: Column | str) -> Column:
    """A number strictly between 0 and 1 that hangs on the parts alone."""
    key = F.md5(F.concat_ws(":", *(F.lit(part) if isinstance(part, str) else part for part in parts)))
    whole = F.conv(F.substring(key, 1, DIGITS), 16, 10).cast("long")
    return (whole + 0.5) / float(16**DIGITS)


def cumulative(mean: Column) -> Column:
    """Cumulative Poisson probabilities of 0, 1, 2, ... as far as a double can tell them from 1."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.array(F.exp(-mean)).alias("all"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        c = state["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.concat(state["all"], F.array(c)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda state: state["all"])


def source_rates(
    docs: DataFrame, weights: Mapping[str, float], other_weight: float = 1.0, rounds: float = 1.0,
    source_column: str = "source", text_column: str = "text",
) -> DataFrame:
    """Per source: rate (mean repetitions), parts and cdf. ``rounds`` scales the whole output."""
    held = docs.groupBy(F.col(source_column).alias("source")).agg(
        F.sum(F.length(text_or_empty(text_column))).alias("chars")
    )
    known = [pair for name, weight in weights.items() for pair in (F.lit(name), F.lit(float(weight)))]
    weight = F.coalesce(F.create_map(*known)[F.col("source")], F.lit(other_weight)) if known else F.lit(other_weight)
    held = Workspace(docs.sparkSession, "source-sizes").keep(held.withColumn("weight", weight), "held")
    # two numbers over the short list of sources
    total = held.where("chars > 0").agg(F.sum("weight"), F.sum("chars")).first()
    weights_sum, chars_sum = float(total[0] or 1.0), int(total[1] or 0)
    rate = F.col("weight") * F.lit(chars_sum) * rounds / (F.lit(weights_sum) * F.col("chars"))
    rated = held.select("source", F.when(F.col("chars") > 0, rate).otherwise(0.0).alias("rate"))
    rated = rated.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / LARGEST_MEAN)).cast("int"))
    return rated.withColumn("cdf", cumulative(F.col("rate") / F.col("parts")))


def replicate(
    docs: DataFrame, weights: Mapping[str, float], seed: str = "mix", other_weight: float = 1.0, rounds: float = 1.0,
    id_column: str = "doc_id", source_column: str = "source", text_column: str = "text", columns: list[str] | None = None,
) -> DataFrame:
    """Every document as often as its count says, in shuffled order.

    Returns ``columns`` (all by default) and, under names that are free, ``copy`` (from 1) and
    ``shuffle_key``.
    """
    work = Workspace(docs.sparkSession, "poisson-mix")
    rates = work.keep(source_rates(docs, weights, other_weight, rounds, source_column, text_column), "rates")
    columns = docs.columns if columns is None else columns
    copy, key, source, name, often = (free_name(docs, wanted) for wanted in ("copy", "shuffle_key", "_from", "_who", "_count"))
    who = F.coalesce(F.col(id_column).cast("string"), F.concat(F.lit("text "), F.md5(text_or_empty(text_column))))
    ready = docs.select(*columns, F.col(source_column).alias(source), who.alias(name))
    joined = ready.join(rates, ready[source].eqNullSafe(rates["source"])).select(
        *(ready[column] for column in columns), name, rates["cdf"], rates["parts"]
    )

    def drawn(total: Column, part: Column) -> Column:
        u = uniform(seed, part.cast("string"), F.col(name))
        return total + F.size(F.filter(rates["cdf"], lambda c: c <= u))

    count = F.aggregate(F.sequence(F.lit(1), rates["parts"]), F.lit(0), drawn)
    counted = joined.select(*(ready[column] for column in columns), name, count.alias(often)).where(F.col(often) > 0)
    copies = counted.select(*columns, name, F.explode(F.sequence(F.lit(1), F.col(often))).alias(copy))
    order = F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), F.col(copy).cast("string"), F.col(name)))
    keyed = copies.select(*columns, copy, order.alias(key))
    return keyed.repartition(F.col(key)).sortWithinPartitions(key)
