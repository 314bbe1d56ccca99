"""A full refresh of the sales tables: every layer is stored before the next one reads it.

Cleaned sales feed five gold tables, so they are computed and checked once and read back, column
by column, from their own table.

Beside its twelve datasets a refresh adds to two kinds of tables: ``quality_report``, a line per
dataset and rule with the rows that passed and failed, and ``<name>_changes`` for each table marked as
tracked, what turned its last snapshot into the new one (nothing on the first refresh).
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.operators import expectations
from goldleaf.plans import bronze, gold, silver
from goldleaf.plans.tracked import REFRESHED_AT, overwrite_tracked
from goldleaf.sources.tables import Layout, append_table, create_schema, gathered_by, overwrite_table

BRONZE = {"quality": "bronze"}
SILVER = {"quality": "silver", "changes": "tracked"}
GOLD = {"quality": "gold"}

LAYOUTS = {
    "bronze_transactions": Layout("Sales as delivered, with audit columns", BRONZE),
    "bronze_customers": Layout("Customers as delivered, with audit columns", BRONZE),
    "bronze_franchises": Layout("Franchises as delivered, with audit columns", BRONZE),
    "bronze_suppliers": Layout("Suppliers as delivered, with audit columns", BRONZE),
    "silver_transactions": Layout(
        "Checked sales with calendar parts and masked cards", SILVER, gather_by=("transaction_date",)
    ),
    "silver_customers": Layout("Checked customers with region", SILVER),
    "silver_franchises": Layout("Franchises with supplier and size code", SILVER),
    "gold_daily_sales_summary": Layout(
        "Sales per day and franchise", GOLD, range_by=("transaction_date", "franchiseID")
    ),
    "gold_customer_360": Layout("Lifetime figures per customer", GOLD, range_by=("customerID",)),
    "gold_product_performance": Layout("Sales per product", GOLD, range_by=("product",)),
    "gold_franchise_performance": Layout("Trading figures per franchise", GOLD, range_by=("franchiseID",)),
    "gold_payment_analysis": Layout(
        "Sales per payment method and day", GOLD, range_by=("transaction_date", "payment_method_clean")
    ),
}


# What identifies a row of a tracked table.
TRACKED_KEYS = {
    "silver_transactions": ("transactionID",),
    "silver_customers": ("customerID",),
    "silver_franchises": ("franchiseID",),
}
# The rules of each checked dataset, where its unchecked rows are, and what happens to bad ones.
CHECKS = {
    "silver_transactions": ("bronze_transactions", expectations.TRANSACTION_RULES, "drop"),
    "silver_customers": ("bronze_customers", expectations.CUSTOMER_RULES, "drop"),
    "silver_franchises": ("bronze_franchises", expectations.FRANCHISE_RULES, "warn"),
}
QUALITY_REPORT = "quality_report"


@dataclass(frozen=True)
class SalesSources:
    transactions: DataFrame
    customers: DataFrame
    franchises: DataFrame
    suppliers: DataFrame
    # the transactions come gathered by day (``by_day``), and their order is kept
    gathered: bool = False


def by_day(sales: DataFrame) -> DataFrame:
    """Sales as delivered, gathered by day."""
    return gathered_by(sales.withColumn("_day", F.to_date("dateTime")), ["_day"]).drop("_day")


def gathered_sales(bronze_sales: DataFrame) -> DataFrame:
    """Cleaned sales gathered by day. The sales are dealt as delivered, and cleaned where they arrive: fewer columns move."""
    return silver.silver_transactions(by_day(bronze_sales))


def _daily_in_order(sales: DataFrame) -> DataFrame:
    """The daily summary comes in ranges of its groups; only their rows are put in order."""
    return gold.daily_sales_summary(sales).sortWithinPartitions("transaction_date", "franchiseID")


# How datasets with a layout as above are made, so that they come as it asks and are not dealt once more.
ARRANGED = {"silver_transactions": gathered_sales, "gold_daily_sales_summary": _daily_in_order}


def refresh_sales(
    spark: SparkSession,
    sources: SalesSources,
    schema: str,
    folder: str,
    layouts: Mapping[str, Layout] = LAYOUTS,
) -> dict[str, DataFrame]:
    """Recompute all twelve datasets as tables of ``schema`` and return them by name.

    Each table is replaced when its new version is complete; a refresh that fails leaves the others as they were.
    """
    create_schema(spark, schema, folder)
    now = datetime.now(timezone.utc)
    # other layouts deal the cleaned rows as they ask
    plans = {name: plan for name, plan in ARRANGED.items() if layouts[name] == LAYOUTS[name]}
    layouts = {**layouts, **{name: replace(layouts[name], as_it_comes=True) for name in plans}}
    if sources.gathered and "silver_transactions" in plans:
        plans["silver_transactions"] = silver.silver_transactions
    stored: dict[str, DataFrame] = {}

    def append(name: str, df: DataFrame) -> None:
        append_table(df.withColumn(REFRESHED_AT, F.lit(now)), f"{schema}.{name}", f"{folder}/{name}")

    def store(**datasets: DataFrame) -> None:
        """Write the datasets of one step side by side, so that the last tasks of one do not
        leave the cluster idle."""
        def write(name: str) -> DataFrame:
            df, layout = datasets[name], layouts[name]
            place = (f"{schema}.{name}", f"{folder}/{name}", layout)
            if layout.properties.get("changes") == "tracked":
                return overwrite_tracked(df, *place, TRACKED_KEYS[name])
            return overwrite_table(df, *place)

        with ThreadPoolExecutor(max_workers=len(datasets)) as writers:
            stored.update(zip(datasets, writers.map(write, datasets)))

    store(
        bronze_transactions=bronze.bronze_transactions(sources.transactions),
        bronze_customers=bronze.bronze_customers(sources.customers),
        bronze_franchises=bronze.bronze_franchises(sources.franchises),
        bronze_suppliers=bronze.bronze_suppliers(sources.suppliers),
    )
    store(
        silver_transactions=plans.get("silver_transactions", silver.silver_transactions)(stored["bronze_transactions"]),
        silver_customers=silver.silver_customers(stored["bronze_customers"]),
        silver_franchises=silver.silver_franchises(stored["bronze_franchises"], stored["bronze_suppliers"]),
    )
    reports = [
        expectations.expectation_report(stored[source], name, rules, action)
        for name, (source, rules, action) in CHECKS.items()
    ]
    append(QUALITY_REPORT, reduce(DataFrame.union, reports))
    sales = stored["silver_transactions"]
    store(
        gold_daily_sales_summary=plans.get("gold_daily_sales_summary", gold.daily_sales_summary)(sales),
        gold_customer_360=gold.customer_360(stored["silver_customers"], sales),
        gold_product_performance=gold.product_performance(sales),
        gold_franchise_performance=gold.franchise_performance(stored["silver_franchises"], sales),
        gold_payment_analysis=gold.payment_analysis(sales),
    )
    return stored


def row_counts(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per dataset, one line each. On stored tables only the file footers are read, and the
    counts stay exact when tasks are repeated."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dataset"), "rows")
        for name, df in datasets.items()
    ]
    lines, *others = counts
    for other in others:
        lines = lines.union(other)
    return lines
