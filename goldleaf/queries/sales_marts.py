"""Gold datasets and the aggregates they are made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldleaf.plans import gold
from goldleaf.queries.common import (
    CUSTOMERS,
    FRANCHISES,
    SILVER_CUSTOMERS,
    SILVER_FRANCHISES,
    SILVER_TRANSACTIONS,
    SUPPLIERS,
    TRANSACTIONS,
    over_sales,
    query,
    silver_buyers,
    silver_sales,
    silver_shops,
    with_tables,
)

_MEAN = "CAST(sum({0}) AS DOUBLE) / count({0})"
_AVG_SALE = _MEAN.format('"totalPrice"') + " AS avg_transaction_value"
_REVENUE = 'CAST(sum("totalPrice") AS BIGINT)'


@query(
    "gold_daily_sales_summary",
    over_sales(
        f"""SELECT transaction_date, "franchiseID", {_REVENUE} AS total_revenue,
                   count("transactionID") AS transaction_count, {_AVG_SALE},
                   count(DISTINCT "customerID") AS unique_customers,
                   CAST(sum(quantity) AS BIGINT) AS total_items_sold,
                   count(DISTINCT product) AS unique_products_sold
            FROM silver_transactions GROUP BY transaction_date, "franchiseID" """
    ),
)
def _(spark, folder):
    return gold.daily_sales_summary(silver_sales(spark, folder))


@query(
    "gold_customer_360",
    with_tables(
        f"""SELECT c."customerID", full_name, email_address, region, country_clean, lifetime_value, total_transactions,
                   avg_transaction_value, first_purchase_date, last_purchase_date,
                   CAST(date_diff('day', first_purchase_date, last_purchase_date) AS INTEGER) AS customer_tenure_days,
                   CASE WHEN date_diff('day', first_purchase_date, last_purchase_date) > 0
                        THEN CAST(total_transactions AS DOUBLE)
                             / date_diff('day', first_purchase_date, last_purchase_date)
                        ELSE 0.0::DOUBLE END AS purchase_frequency,
                   franchises_visited
            FROM silver_customers c LEFT JOIN (
              SELECT "customerID", {_REVENUE} AS lifetime_value, count("transactionID") AS total_transactions, {_AVG_SALE},
                     min(transaction_date) AS first_purchase_date, max(transaction_date) AS last_purchase_date,
                     count(DISTINCT "franchiseID") AS franchises_visited
              FROM silver_transactions GROUP BY "customerID"
            ) m ON c."customerID" = m."customerID" """,
        TRANSACTIONS,
        SILVER_TRANSACTIONS,
        CUSTOMERS,
        SILVER_CUSTOMERS,
    ),
)
def _(spark, folder):
    return gold.customer_360(silver_buyers(spark, folder), silver_sales(spark, folder))


@query(
    "gold_product_performance",
    over_sales(
        f"""SELECT product, CAST(sum(quantity) AS BIGINT) AS total_units_sold, {_REVENUE} AS total_revenue,
                   count("transactionID") AS transaction_count,
                   {_MEAN.format('"unitPrice"')} AS avg_unit_price,
                   {_MEAN.format('quantity')} AS avg_quantity_per_transaction,
                   count(DISTINCT "franchiseID") AS franchise_count,
                   count(DISTINCT "customerID") AS unique_customers,
                   CAST(sum("totalPrice") AS DOUBLE) / CAST(sum(quantity) AS DOUBLE) AS revenue_per_unit
            FROM silver_transactions GROUP BY product"""
    ),
)
def _(spark, folder):
    return gold.product_performance(silver_sales(spark, folder))


_PEAK = """
hours AS (
  SELECT "franchiseID", transaction_hour AS peak_hour,
         row_number() OVER (PARTITION BY "franchiseID" ORDER BY count(*) DESC, transaction_hour) AS place
  FROM silver_transactions GROUP BY "franchiseID", transaction_hour
)"""


@query(
    "gold_franchise_performance",
    with_tables(
        f"""SELECT f."franchiseID", name, city, country, size_category, supplier_name, primary_ingredient,
                   total_revenue, total_transactions, avg_transaction_value, unique_customers,
                   avg_items_per_transaction, peak_hour,
                   round(CAST(weekend_revenue AS DOUBLE) / CAST(total_revenue AS DOUBLE) * 100, 2) AS weekend_revenue_pct,
                   latitude, longitude
            FROM silver_franchises f LEFT JOIN (
              SELECT "franchiseID", {_REVENUE} AS total_revenue, count("transactionID") AS total_transactions, {_AVG_SALE},
                     count(DISTINCT "customerID") AS unique_customers,
                     {_MEAN.format('quantity')} AS avg_items_per_transaction,
                     sum(CASE WHEN is_weekend THEN "totalPrice" ELSE 0 END) AS weekend_revenue
              FROM silver_transactions GROUP BY "franchiseID"
            ) m ON f."franchiseID" = m."franchiseID"
            LEFT JOIN hours h ON f."franchiseID" = h."franchiseID" AND h.place = 1""",
        TRANSACTIONS,
        SILVER_TRANSACTIONS,
        FRANCHISES,
        SUPPLIERS,
        SILVER_FRANCHISES,
        _PEAK,
    ),
)
def _(spark, folder):
    return gold.franchise_performance(silver_shops(spark, folder), silver_sales(spark, folder))


@query(
    "gold_payment_analysis",
    over_sales(
        f"""SELECT payment_method_clean, transaction_date, {_REVENUE} AS total_revenue,
                   count("transactionID") AS transaction_count, {_AVG_SALE}
            FROM silver_transactions GROUP BY payment_method_clean, transaction_date"""
    ),
)
def _(spark, folder):
    return gold.payment_analysis(silver_sales(spark, folder))


@query(
    "agg_sum_count_avg",
    over_sales(
        f"""SELECT "franchiseID", {_REVENUE} AS total_revenue, count("transactionID") AS transaction_count, {_AVG_SALE}
            FROM silver_transactions GROUP BY "franchiseID" """
    ),
)
def _(spark, folder):
    return silver_sales(spark, folder).groupBy("franchiseID").agg(*gold._takings())


@query(
    "agg_multi_distinct",
    over_sales(
        """SELECT "franchiseID", count(DISTINCT "customerID") AS unique_customers,
                  count(DISTINCT product) AS unique_products, count(DISTINCT transaction_date) AS trading_days
           FROM silver_transactions GROUP BY "franchiseID" """
    ),
)
def _(spark, folder):
    return silver_sales(spark, folder).groupBy("franchiseID").agg(
        F.count_distinct("customerID").alias("unique_customers"),
        F.count_distinct("product").alias("unique_products"),
        F.count_distinct("transaction_date").alias("trading_days"),
    )


@query("agg_mode", over_sales('SELECT "franchiseID", peak_hour FROM hours WHERE place = 1').replace("\nSELECT", "," + _PEAK + "\nSELECT", 1))
def _(spark, folder):
    return gold.peak_hour(silver_sales(spark, folder))


@query(
    "agg_conditional_sum",
    over_sales(
        """SELECT "franchiseID", CAST(sum(CASE WHEN is_weekend THEN "totalPrice" ELSE 0 END) AS BIGINT) AS weekend_revenue,
                  CAST(sum(CASE WHEN NOT is_weekend THEN "totalPrice" ELSE 0 END) AS BIGINT) AS weekday_revenue
           FROM silver_transactions GROUP BY "franchiseID" """
    ),
)
def _(spark, folder):
    return gold.weekend_split(silver_sales(spark, folder))


@query(
    "favorite_product",
    over_sales(
        """SELECT "customerID", favorite_product, purchases FROM (
             SELECT "customerID", product AS favorite_product, count(*) AS purchases,
                    row_number() OVER (PARTITION BY "customerID" ORDER BY count(*) DESC, product) AS place
             FROM silver_transactions GROUP BY "customerID", product
           ) WHERE place = 1"""
    ),
)
def _(spark, folder):
    return gold.favorite_product(silver_sales(spark, folder))
