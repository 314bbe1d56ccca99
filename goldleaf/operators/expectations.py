"""Named data-quality rules: drop, warn, fail and report.

A rule is a boolean SQL text over the columns of the dataset it guards. Only TRUE passes: a rule
that comes out NULL counts as violated everywhere below.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = Mapping[str, str]

# The rules the sales tables are held to.
TRANSACTION_RULES = {
    "valid_transaction_id": "transactionID IS NOT NULL",
    "valid_customer_id": "customerID IS NOT NULL",
    "valid_franchise_id": "franchiseID IS NOT NULL",
    "positive_quantity": "quantity > 0",
    "positive_total": "totalPrice > 0",
}
CUSTOMER_RULES = {
    "valid_customer_id": "customerID IS NOT NULL",
    "valid_email": "email_address IS NOT NULL AND email_address LIKE '%@%'",
}
FRANCHISE_RULES = {
    "valid_franchise_id": "franchiseID IS NOT NULL",
    "valid_location": "city IS NOT NULL AND country IS NOT NULL",
}


def all_hold(rules: Rules) -> Column:
    """The conjunction, left bare so that the optimizer can push its parts into the scan."""
    return reduce(and_, (F.expr(rule) for rule in rules.values()))


def _violations(rule: str) -> Column:
    return F.count_if(~F.coalesce(F.expr(rule), F.lit(False)))


def drop_violations(df: DataFrame, rules: Rules) -> DataFrame:
    return df.filter(all_hold(rules))


def violated_rules(rules: Rules) -> Column:
    """The names of the rules a row violates, in the order of the rules; empty for a good row."""
    names = [F.when(~F.coalesce(F.expr(rule), F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return F.array_compact(F.array(*names))


def warn_violations(df: DataFrame, rules: Rules, observation: Observation | None = None) -> DataFrame:
    """Keep every row. With an observation the counts ride along with the next action; which rules a
    row violates is told by ``violated_rules``.

    An observation blocks filter pushdown below it and may count a task twice when its executor
    is lost; ``expectation_report`` gives exact counts as a job of its own.
    """
    if observation is None:
        return df
    counts = [_violations(rule).alias(name) for name, rule in rules.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *counts)


def fail_on_violation(df: DataFrame, rules: Rules) -> DataFrame:
    """Stop the query at the first bad row.

    The check sits in the filter itself, so column pruning cannot remove it.
    """
    def checked(name: str, rule: str) -> Column:
        stop = F.raise_error(F.lit(f"expectation failed: {name} ({rule})")).cast("boolean")
        return F.when(F.expr(rule), F.lit(True)).otherwise(stop)

    return df.filter(reduce(and_, (checked(name, rule) for name, rule in rules.items())))


def expectation_report(df: DataFrame, dataset: str, rules: Rules, action: str) -> DataFrame:
    """One line per rule: dataset, rule, action, passed and failed rows. One pass over the data."""
    totals = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(_violations(rule).alias(name) for name, rule in rules.items()),
    )
    lines = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(name).alias("rule"),
            F.lit(action).alias("action"),
            (F.col("_rows") - F.col(name)).alias("passed"),
            F.col(name).alias("failed"),
        )
        for name in rules
    ]
    return totals.select(F.inline(F.array(*lines)))
