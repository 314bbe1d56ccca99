"""Gold tables kept up to date from the change feed of cleaned sales, instead of recomputed.

Changes are signed sums: what came in counts once, what went counts minus once. They are added to the stored figures of
the (day, franchise) or (day, payment method) groups they touch. Distinct counts cannot be added up, so those of touched
groups, and only those, are counted again from the sales of the touched days. Groups without a sale left go away. Other
groups of a touched day are carried over, other days are neither read nor written: sales and stored figures
are filtered by the touched days, of which there are as many as days in the calendar at most.

Each table says which version of the sales it reflects. An update first writes the touched days' new figures aside, then
replaces these days, then moves that mark on. If it breaks off after the first step, the next call takes the figures laid
aside, so no change is added twice. Sums of doubles may drift by rounding; sums of whole numbers are exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.functions.measures import ratio
from goldleaf.operators.changes import CHANGE_TYPE, COPIES
from goldleaf.plans import gold
from goldleaf.plans.refresh import ARRANGED, LAYOUTS
from goldleaf.plans.tracked import pending_changes
from goldleaf.sources.tables import (
    finish_publishing,
    folders,
    overwrite_table,
    remove_folder,
    replace_partitions,
    set_properties,
    table_property,
    table_version,
)

DAY = "transaction_date"
SALES = "silver_transactions"
REFLECTS = "reflects_sales"


@dataclass(frozen=True)
class Figures:
    """A gold table that changes can be added to: its groups, added and recounted columns, and how it is computed whole."""

    groups: Sequence[str]
    sums: dict[str, str]
    recounted: dict[str, str]
    whole: object


TABLES = {
    "gold_daily_sales_summary": Figures(
        (DAY, "franchiseID"), {"total_revenue": "totalPrice", "total_items_sold": "quantity"},
        {"unique_customers": "customerID", "unique_products_sold": "product"}, gold.daily_sales_summary,
    ),
    "gold_payment_analysis": Figures(
        (DAY, "payment_method_clean"), {"total_revenue": "totalPrice"}, {}, gold.payment_analysis
    ),
}


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    return reduce(and_, (F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}")) for name in columns))


def on_days(df: DataFrame, days: Sequence) -> DataFrame:
    """Rows of these days, as a filter that reaches the scan."""
    known = [day for day in days if day is not None]
    chosen = F.col(DAY).isin(known) if known else F.lit(False)
    return df.where(chosen | F.col(DAY).isNull() if None in days else chosen)


def changed_groups(changes: DataFrame, figures: Figures) -> DataFrame:
    """By how much the figures of each touched group move."""
    n = F.when(F.col(CHANGE_TYPE).isin("insert", "update_postimage"), F.col(COPIES)).otherwise(-F.col(COPIES))
    moved = [F.sum(n * F.col(column)).alias(name) for name, column in figures.sums.items()]
    sold = F.sum(F.when(F.col("transactionID").isNotNull(), n).otherwise(0)).alias("transaction_count")
    return changes.groupBy(*figures.groups).agg(sold, *moved)


def updated_days(stored: DataFrame, changes: DataFrame, sales: DataFrame, figures: Figures, days: Sequence) -> DataFrame:
    """All rows that the touched days have after the changes. ``sales`` are the cleaned sales as they are now."""
    keys, added = list(figures.groups), ["transaction_count", *figures.sums]
    before = on_days(stored, days)
    delta = changed_groups(changes, figures)
    together = before.select(*keys, *added, F.lit(0).alias("_touched")).unionByName(
        delta.select(*keys, *added, F.lit(1).alias("_touched"))
    )
    sums = [F.sum(name).cast(stored.schema[name].dataType).alias(name) for name in added]
    moved = together.groupBy(*keys).agg(*sums, F.max("_touched").alias("_touched")).where("_touched = 1 AND transaction_count > 0")
    moved = moved.withColumn("avg_transaction_value", ratio(F.col("total_revenue"), F.col("transaction_count")))
    if figures.recounted:
        touched = delta.select(*keys).alias("t")
        of_groups = on_days(sales, days).alias("s").join(touched, _same("s", "t", keys), "left_semi")
        counts = of_groups.groupBy(*keys).agg(
            *(F.count_distinct(column).alias(name) for name, column in figures.recounted.items())
        )
        moved = moved.alias("m").join(counts.alias("c"), _same("m", "c", keys)).select("m.*", *figures.recounted)
    carried = before.alias("b").join(delta.select(*keys).alias("t"), _same("b", "t", keys), "left_anti")
    return carried.unionByName(moved.select(*stored.columns))


def _layout(name: str):
    return replace(LAYOUTS[name], partition_by=(DAY,), range_by=(), gather_by=())


def build(spark: SparkSession, schema: str, folder: str, names: Sequence[str] = tuple(TABLES)) -> dict[str, DataFrame]:
    """Compute the tables whole from the sales as they are now, partitioned by day."""
    out = {}
    for name in names:
        version = table_version(spark, f"{schema}.{SALES}")
        properties = {**LAYOUTS[name].properties, REFLECTS: version}
        # what comes in order of its days is not dealt by day once more
        layout = replace(_layout(name), properties=properties, as_it_comes=name in ARRANGED)
        whole = ARRANGED.get(name, TABLES[name].whole)
        out[name] = overwrite_table(whole(spark.read.table(f"{schema}.{SALES}")), f"{schema}.{name}", f"{folder}/{name}", layout)
    return out


def _replace_days(spark: SparkSession, schema: str, folder: str, name: str, aside: str, version: str) -> None:
    """The last steps of an update: the days laid aside replace those of the table, and the mark moves on."""
    table = f"{schema}.{name}"
    new = spark.read.parquet(f"{aside}/{version}/rows").select(*spark.read.table(table).columns)
    gone = spark.read.parquet(f"{aside}/{version}/days").join(new.select(DAY).distinct(), DAY, "left_anti")
    replace_partitions(new, table, f"{folder}/{name}", _layout(name), gone)
    set_properties(spark, table, {REFLECTS: version})
    remove_folder(spark, aside)


def apply_changes(spark: SparkSession, schema: str, folder: str, names: Sequence[str] = tuple(TABLES)) -> dict[str, int]:
    """Bring the tables up to the sales as they are now, and tell how many days of each were touched."""
    touched = {}
    sales_table = f"{schema}.{SALES}"
    finish_publishing(spark, sales_table)
    for name in names:
        figures = TABLES[name]
        table, aside = f"{schema}.{name}", f"{folder}/_aside/{name}"
        for version in folders(spark, aside):
            if "rows" in folders(spark, f"{aside}/{version}") and "_SUCCESS" in folders(spark, f"{aside}/{version}/rows"):
                _replace_days(spark, schema, folder, name, aside, version)
            else:
                remove_folder(spark, aside)
        now = table_version(spark, sales_table)
        changes = pending_changes(spark, sales_table, table_property(spark, table, REFLECTS))
        days = [] if changes is None else [row[0] for row in changes.select(DAY).distinct().collect()]
        touched[name] = len(days)
        if days:
            schema_of_days = spark.read.table(table).select(DAY).schema
            # the days first: figures laid aside are complete when their rows are
            spark.createDataFrame([(day,) for day in days], schema_of_days).write.parquet(f"{aside}/{now}/days")
            rows = updated_days(spark.read.table(table), changes, spark.read.table(sales_table), figures, days)
            rows.write.parquet(f"{aside}/{now}/rows")
            _replace_days(spark, schema, folder, name, aside, now)
        elif changes is not None:
            set_properties(spark, table, {REFLECTS: now})
    return touched
