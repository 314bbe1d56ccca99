"""Tables written and read back, changes between snapshots, files and streams."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from goldleaf.operators.changes import snapshot_changes, versions_from_changes
from goldleaf.operators.expectations import TRANSACTION_RULES
from goldleaf.plans import bronze, gold_changes, history, refresh, tracked
from goldleaf.queries.common import (
    CUSTOMERS,
    FRANCHISES,
    ORACLES,
    SILVER_CUSTOMERS,
    SILVER_FRANCHISES,
    SILVER_TRANSACTIONS,
    SUPPLIERS,
    TRANSACTIONS,
    naive_times,
    over_sales,
    query,
    silver_sales,
    with_tables,
)
from goldleaf.session import run_folder
from goldleaf.sources import files, tables
from goldleaf.sources import sample_tables as sample
from goldleaf.streaming import ingest, quarantine


def _new_schema(spark, label):
    """A schema of its own in the shared folder for each run."""
    name, folder = f"{label}_{uuid.uuid4().hex[:12]}", run_folder(spark, label)
    tables.create_schema(spark, name, folder)
    return name, folder


@query(
    "materialize_roundtrip",
    over_sales(
        """SELECT "franchiseID", payment_method_clean, count(*) AS sales FROM silver_transactions
           GROUP BY "franchiseID", payment_method_clean"""
    ),
)
def _(spark, folder):
    schema, place = _new_schema(spark, "roundtrip")
    layout = tables.Layout(
        "Checked sales", {"quality": "silver"}, partition_by=("payment_method_clean",), gather_by=("transaction_date",)
    )
    stored = tables.overwrite_table(silver_sales(spark, folder), f"{schema}.sales", f"{place}/sales", layout)
    return stored.groupBy("franchiseID", "payment_method_clean").agg(F.count(F.lit(1)).alias("sales"))


@query(
    "clustered_write_scan",
    over_sales(
        """SELECT transaction_date, count(*) AS sales, CAST(sum("totalPrice") AS BIGINT) AS revenue FROM silver_transactions
           WHERE transaction_date BETWEEN DATE '1997-03-01' AND DATE '1997-05-31' GROUP BY transaction_date"""
    ),
)
def _(spark, folder):
    schema, place = _new_schema(spark, "clustered")
    layout = refresh.LAYOUTS["silver_transactions"]
    stored = tables.overwrite_table(silver_sales(spark, folder), f"{schema}.sales", f"{place}/sales", layout)
    spring = stored.filter(F.col("transaction_date").between("1997-03-01", "1997-05-31"))
    return spring.groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("sales"), F.sum("totalPrice").alias("revenue")
    )


@query(
    "overwrite_new_schema",
    over_sales('SELECT "transactionID", "franchiseID", "totalPrice" * 2 AS doubled FROM silver_transactions'),
)
def _(spark, folder):
    schema, place = _new_schema(spark, "replaced")
    sales = silver_sales(spark, folder).select("transactionID", "franchiseID", "totalPrice")
    tables.overwrite_table(sales, f"{schema}.sales", f"{place}/sales")
    doubled = sales.withColumn("doubled", F.col("totalPrice") * 2).drop("totalPrice")
    return tables.overwrite_table(doubled, f"{schema}.sales", f"{place}/sales")


@query(
    "publish_after_failed_write",
    over_sales(
        """SELECT "franchiseID", count(*) AS sales, CAST(sum("totalPrice") AS BIGINT) AS revenue, 'silver' AS quality,
                  CAST(1 AS BIGINT) AS versions
           FROM silver_transactions GROUP BY "franchiseID\""""
    ),
)
def _(spark, folder):
    """A second version with other columns and rows fails in the task that holds the last sale: the first one is still shown."""
    schema, place = _new_schema(spark, "published")
    name, path = f"{schema}.sales", f"{place}/sales"
    sales = silver_sales(spark, folder).select("transactionID", "franchiseID", "totalPrice")
    first = tables.overwrite_table(sales, name, path, tables.Layout("Checked sales", {"quality": "silver"}))
    last = first.agg(F.max("transactionID")).first()[0]
    lost = F.when(F.col("transactionID") == last, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("totalPrice") * 2)
    for broken in (first.withColumn("doubled", lost).drop("totalPrice"), first.withColumn("totalPrice", lost)):
        try:
            tables.overwrite_table(broken, name, path, tables.Layout("Doubled", {"quality": "gold"}))
        except Exception as error:
            if "lost" not in str(error):
                raise
    shown = spark.read.table(name)
    return shown.groupBy("franchiseID").agg(F.count("transactionID").alias("sales"), F.sum("totalPrice").alias("revenue")).select(
        "*", F.lit(tables.table_property(spark, name, "quality")).alias("quality"),
        F.lit(sum(entry.startswith(tables.VERSION) for entry in tables.folders(spark, path))).cast("long").alias("versions"),
    )


def _gold_updated(spark, folder, name):
    """Earlier sales as a stored table with a gold table, then today's as its next version, and gold brought up by the changes.

    The earlier version lacks some sales of one spring, has some that went later, and others at another price or franchise.
    """
    schema, place = _new_schema(spark, "gold_changes")
    with tables.discarding(spark):
        # three plans read today's sales: their joins run once, and they are gathered by day once
        today = tables.stored(
            refresh.gathered_sales(bronze.bronze_transactions(sample.sales_transactions(spark, folder))), "today"
        )
        _update_gold(spark, schema, place, name, today)
    return spark.read.table(f"{schema}.{name}")


def _update_gold(spark, schema, place, name, today):
    key, spring = F.col("transactionID"), F.col("transaction_date").between("1997-03-01", "1997-03-20")
    gone_later = today.where(spring & (key % 10 == 1)).withColumn("transactionID", -key)
    earlier = today.where(~spring | (key % 7 != 2)).withColumns(
        {
            "totalPrice": F.when(spring & (key % 9 == 4), F.col("totalPrice") + 5).otherwise(F.col("totalPrice")),
            "franchiseID": F.when(spring & (key % 11 == 5), F.col("franchiseID") + 1).otherwise(F.col("franchiseID")),
        }
    )
    layout = replace(refresh.LAYOUTS["silver_transactions"], as_it_comes=True)
    for version in (earlier.unionByName(gone_later), today):
        tracked.overwrite_tracked(
            version, f"{schema}.silver_transactions", f"{place}/silver_transactions", layout, refresh.TRACKED_KEYS["silver_transactions"]
        )
        if version is not today:
            gold_changes.build(spark, schema, place, [name])
    gold_changes.apply_changes(spark, schema, place, [name])


@query(
    "gold_from_changes",
    over_sales(
        """SELECT transaction_date, "franchiseID", CAST(sum("totalPrice") AS BIGINT) AS total_revenue,
                  count("transactionID") AS transaction_count, avg("totalPrice") AS avg_transaction_value,
                  count(DISTINCT "customerID") AS unique_customers, CAST(sum(quantity) AS BIGINT) AS total_items_sold,
                  count(DISTINCT product) AS unique_products_sold
           FROM silver_transactions GROUP BY transaction_date, "franchiseID\""""
    ),
)
def _(spark, folder):
    return _gold_updated(spark, folder, "gold_daily_sales_summary")


@query(
    "payment_from_changes",
    over_sales(
        """SELECT payment_method_clean, transaction_date, CAST(sum("totalPrice") AS BIGINT) AS total_revenue,
                  count("transactionID") AS transaction_count, avg("totalPrice") AS avg_transaction_value
           FROM silver_transactions GROUP BY payment_method_clean, transaction_date"""
    ),
)
def _(spark, folder):
    return _gold_updated(spark, folder, "gold_payment_analysis")


_COUNTS = [
    ("bronze_transactions", "transactions"),
    ("bronze_customers", "customers"),
    ("bronze_franchises", "franchises"),
    ("bronze_suppliers", "suppliers"),
    ("silver_transactions", "silver_transactions"),
    ("silver_customers", "silver_customers"),
    ("silver_franchises", "silver_franchises"),
    ("gold_daily_sales_summary", 'SELECT DISTINCT transaction_date, "franchiseID" FROM silver_transactions'),
    ("gold_customer_360", "silver_customers"),
    ("gold_product_performance", "SELECT DISTINCT product FROM silver_transactions"),
    ("gold_franchise_performance", "silver_franchises"),
    ("gold_payment_analysis", "SELECT DISTINCT transaction_date, payment_method_clean FROM silver_transactions"),
]


@query(
    "run_row_counts",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{name}' AS dataset, count(*) AS rows FROM " + (f"({rows})" if " " in rows else rows)
            for name, rows in _COUNTS
        ),
        TRANSACTIONS,
        CUSTOMERS,
        FRANCHISES,
        SUPPLIERS,
        SILVER_TRANSACTIONS,
        SILVER_CUSTOMERS,
        SILVER_FRANCHISES,
    ),
)
def _(spark, folder):
    sources = refresh.SalesSources(
        sample.sales_transactions(spark, folder),
        sample.sales_customers(spark, folder),
        sample.sales_franchises(spark, folder),
        sample.sales_suppliers(spark, folder),
    )
    schema, place = f"refresh_{uuid.uuid4().hex[:12]}", run_folder(spark, "refresh")
    return refresh.row_counts(refresh.refresh_sales(spark, sources, schema, place))


@query(
    "refresh_change_feed",
    with_tables(
        """SELECT "customerID", state_clean, 'insert' AS change_type, CAST(1 AS BIGINT) AS copies FROM silver_customers
           WHERE "customerID" % 60 = 5 AND "customerID" % 70 <> 3
           UNION ALL SELECT "customerID", state_clean, 'delete', 1 FROM silver_customers
           WHERE "customerID" % 70 = 3 AND "customerID" % 60 <> 5
           UNION ALL SELECT "customerID", state_clean, 'update_preimage', 1 FROM silver_customers WHERE "customerID" % 50 = 0
           UNION ALL SELECT "customerID", 'MOVED', 'update_postimage', 1 FROM silver_customers WHERE "customerID" % 50 = 0""",
        CUSTOMERS,
        SILVER_CUSTOMERS,
    ),
)
def _(spark, folder):
    """Two full refreshes, the second with other customers: what the stored change feed says of them."""
    customers, key = sample.sales_customers(spark, folder), F.col("customerID")
    moved = F.when(key % 50 == 0, F.lit(" moved ")).otherwise(F.col("state"))
    schema, place = f"feed_{uuid.uuid4().hex[:12]}", run_folder(spark, "feed")
    with tables.discarding(spark):
        # both refreshes read the same sales: their joins run once, and they are gathered by day once
        sales = tables.stored(refresh.by_day(sample.sales_transactions(spark, folder)), "sales")
        for version in (customers.where(key % 60 != 5), customers.where(key % 70 != 3).withColumn("state", moved)):
            sources = refresh.SalesSources(
                sales, version, sample.sales_franchises(spark, folder), sample.sales_suppliers(spark, folder), gathered=True
            )
            refresh.refresh_sales(spark, sources, schema, place)
    changes = spark.read.table(f"{schema}.silver_customers_changes")
    return changes.select("customerID", "state_clean", "change_type", "copies")


@query(
    "top_n_preview",
    over_sales(
        """SELECT "transactionID", "franchiseID", product, "totalPrice" FROM silver_transactions
           ORDER BY "totalPrice" DESC, "transactionID", "franchiseID", product LIMIT 10"""
    ),
)
def _(spark, folder):
    sales = silver_sales(spark, folder).select("transactionID", "franchiseID", "product", "totalPrice")
    return sales.orderBy(F.desc("totalPrice"), "transactionID", "franchiseID", "product").limit(10)


_SNAPSHOTS = """
WITH before AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
), after AS (
  SELECT CASE WHEN o_orderkey % 50 = 2 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, CASE WHEN o_orderkey % 30 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
         CASE WHEN o_orderkey % 20 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority
  FROM orders
)
"""


@query(
    "snapshot_changes",
    _SNAPSHOTS
    + """
SELECT a.*, 'insert' AS change_type, CAST(1 AS BIGINT) AS copies
FROM after a LEFT JOIN before b ON a.o_orderkey = b.o_orderkey WHERE b.o_orderkey IS NULL
UNION ALL
SELECT b.*, 'delete', CAST(1 AS BIGINT)
FROM before b LEFT JOIN after a ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL
UNION ALL
SELECT b.*, 'update_preimage', CAST(1 AS BIGINT) FROM before b JOIN after a ON a.o_orderkey = b.o_orderkey
WHERE a.o_custkey IS DISTINCT FROM b.o_custkey OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus
UNION ALL
SELECT a.*, 'update_postimage', CAST(1 AS BIGINT) FROM before b JOIN after a ON a.o_orderkey = b.o_orderkey
WHERE a.o_custkey IS DISTINCT FROM b.o_custkey OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus
""",
)
def _(spark, folder):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    before = sample.table(spark, folder, "orders").select(*columns)
    after = before.withColumns(
        {
            "o_orderkey": F.expr("CASE WHEN o_orderkey % 50 = 2 THEN -o_orderkey ELSE o_orderkey END"),
            "o_custkey": F.expr("CASE WHEN o_orderkey % 30 <> 0 THEN o_custkey END"),
            "o_orderstatus": F.expr("CASE WHEN o_orderkey % 20 = 0 THEN 'X' ELSE o_orderstatus END"),
        }
    )
    return snapshot_changes(before, after, ["o_orderkey"])


@query(
    "scd2_from_changes",
    """SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderdate AS effective_from,
              lead(o_orderdate) OVER w AS effective_to, lead(o_orderkey) OVER w IS NULL AS is_current
       FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def _(spark, folder):
    changes = sample.table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")
    history = versions_from_changes(
        changes, ["o_custkey"], ["o_orderdate", "o_orderkey"], bucket=F.to_date("o_orderdate")
    )
    return naive_times(history)


@query("json_source_roundtrip", with_tables("SELECT * FROM transactions", TRANSACTIONS))
def _(spark, folder):
    sales, place = sample.sales_transactions(spark, folder), run_folder(spark, "json")
    files.write_json(sales, place)
    return naive_times(files.read_json(spark, place, sales.schema))


@query("stream_ingest_silver", over_sales("SELECT * FROM silver_transactions"))
def _(spark, folder):
    orders, part = sample.table(spark, folder, "orders"), sample.table(spark, folder, "part")
    schema = sample.table(spark, folder, "lineitem").schema
    lines = files.stream_files(spark, folder, schema, "parquet", name_pattern="lineitem.parquet")
    place = run_folder(spark, "stream")
    ingest.run_to_end(
        ingest.append_available(
            sample.sales_lines(lines, orders, part),
            ingest.to_silver_transactions,
            f"{place}/silver_transactions",
            f"{place}/checkpoint",
        )
    )
    return naive_times(files.read_parquet(spark, f"{place}/silver_transactions").drop("_ingested_at"))


@query("history_from_batches", ORACLES["scd2_from_changes"])
def _(spark, folder):
    """The same history, kept up by three batches: late orders come second, and the third brings some of them again."""
    changes = sample.table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")
    name = f"history_{uuid.uuid4().hex[:12]}"
    place = run_folder(spark, "history")
    tables.create_schema(spark, name, place)
    kept = history.History(
        f"{name}.orders", f"{place}/orders", ["o_custkey"], ["o_orderdate", "o_orderkey"], F.to_date("o_orderdate"), parts=8
    )
    year = F.coalesce(F.year("o_orderdate"), F.lit(0))
    for batch in (year >= 1996, year < 1994, (year < 1993) | year.isin(1994, 1995)):
        history.apply_batch(changes.where(batch), kept)
    return naive_times(history.read_history(spark, kept))


# The rules as SQL conditions, by name.
_VIOLATED = {
    "valid_transaction_id": '"transactionID" IS NULL',
    "valid_customer_id": '"customerID" IS NULL',
    "valid_franchise_id": '"franchiseID" IS NULL',
    "positive_quantity": "NOT coalesce(quantity > 0, false)",
    "positive_total": 'NOT coalesce("totalPrice" > 0, false)',
}


def _checked_stream(spark, folder):
    """Sales lines taken in as a stream and held against the rules: where they are stored, and their schema."""
    orders, part = sample.table(spark, folder, "orders"), sample.table(spark, folder, "part")
    schema = sample.table(spark, folder, "lineitem").schema
    lines = files.stream_files(spark, folder, schema, "parquet", name_pattern="lineitem.parquet")
    sales, place = sample.sales_lines(lines, orders, part), run_folder(spark, "stream")
    kept = ["transactionID", "customerID", "franchiseID", "quantity", "totalPrice"]
    ingest.run_to_end(
        quarantine.append_checked(sales, lambda df: df.select(*kept), TRANSACTION_RULES, f"{place}/sales", f"{place}/checkpoint")
    )
    return f"{place}/sales", sales.select(*kept).schema


@query(
    "stream_quarantine",
    with_tables(
        f"""SELECT * FROM (SELECT "transactionID", "customerID", "franchiseID", quantity, "totalPrice",
                   concat_ws(',', {", ".join(f"CASE WHEN {bad} THEN '{name}' END" for name, bad in _VIOLATED.items())}) AS violated
            FROM transactions) WHERE violated <> ''""",
        TRANSACTIONS,
    ),
)
def _(spark, folder):
    bad = quarantine.quarantined_rows(spark, *_checked_stream(spark, folder))
    return bad.withColumn("violated", F.array_join(quarantine.VIOLATED, ",")).drop(quarantine.VIOLATED, quarantine.BATCH)


@query(
    "stream_rule_counts",
    with_tables(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS rule, count(*) - count(CASE WHEN {bad} THEN 1 END) AS passed,
                       count(CASE WHEN {bad} THEN 1 END) AS failed FROM transactions"""
            for name, bad in _VIOLATED.items()
        ),
        TRANSACTIONS,
    ),
)
def _(spark, folder):
    counts = quarantine.rule_counts(spark, _checked_stream(spark, folder)[0])
    return counts.groupBy("rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))
