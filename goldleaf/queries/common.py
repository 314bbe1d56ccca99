"""Registration, shared CTE texts and small helpers for the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.plans import bronze, silver
from goldleaf.sources import sample_tables as sample

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with its SQL counterpart where one exists."""
    def keep(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return keep


def naive_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the SQL side has them."""
    zoned = {name: F.col(name).cast("timestamp_ntz") for name, kind in df.dtypes if kind == "timestamp"}
    return df.withColumns(zoned) if zoned else df


def bronze_sales(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.bronze_transactions(sample.sales_transactions(spark, folder))


def silver_sales(spark: SparkSession, folder: str) -> DataFrame:
    return silver.silver_transactions(bronze_sales(spark, folder)).drop("_ingested_at")


def silver_buyers(spark: SparkSession, folder: str) -> DataFrame:
    source = bronze.bronze_customers(sample.sales_customers(spark, folder))
    return silver.silver_customers(source).drop("_ingested_at")


def silver_shops(spark: SparkSession, folder: str) -> DataFrame:
    shops = bronze.bronze_franchises(sample.sales_franchises(spark, folder))
    suppliers = bronze.bronze_suppliers(sample.sales_suppliers(spark, folder))
    return silver.silver_franchises(shops, suppliers).drop("_ingested_at")


# The domain tables as SQL, for the other side of the comparison.
TRANSACTIONS = """
transactions AS (
  SELECT l_orderkey * 10 + l_linenumber AS "transactionID",
         CASE WHEN l_orderkey % 97 <> 0 AND o_custkey % 41 <> 0 THEN o_custkey END AS "customerID",
         CASE WHEN l_suppkey <> 7 THEN l_suppkey END AS "franchiseID",
         l_shipdate + to_hours(CAST((l_orderkey * 7 + l_linenumber * 3) % 24 AS INTEGER)) AS "dateTime",
         p_name AS product,
         CAST(CASE WHEN l_partkey % 101 = 0 THEN 0 ELSE l_quantity END AS BIGINT) AS quantity,
         CAST(floor(p_retailprice) AS BIGINT) AS "unitPrice",
         CAST(CASE WHEN l_suppkey % 53 = 0 AND l_linenumber = 1 THEN -1 ELSE 1 END * floor(l_extendedprice) AS BIGINT)
           AS "totalPrice",
         '  ' || lower(o_orderpriority) || ' ' AS "paymentMethod",
         CASE WHEN l_orderkey % 89 <> 0 THEN 4000000000000000 + l_orderkey * 1000 + l_linenumber END AS "cardNumber"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""

CUSTOMERS = """
customers AS (
  SELECT c_custkey AS "customerID",
         CASE WHEN c_custkey % 19 <> 0 THEN 'Customer' END AS first_name,
         substr(c_name, 10, 9) AS last_name,
         CASE WHEN c_custkey % 13 = 0 THEN NULL
              WHEN c_custkey % 17 = 0 THEN 'no-address-' || substr(c_name, 10, 9)
              ELSE 'c' || substr(c_name, 10, 9) || '@example.com' END AS email_address,
         ' ' || lower(n_name) AS country,
         lower(c_mktsegment) AS state,
         CASE r_name WHEN 'AMERICA' THEN 'North America' WHEN 'EUROPE' THEN 'Europe' WHEN 'ASIA' THEN 'Asia'
              ELSE r_name END AS continent
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

FRANCHISES = """
franchises AS (
  SELECT s_suppkey AS "franchiseID",
         CASE WHEN s_suppkey % 10 = 9 THEN -s_suppkey ELSE s_suppkey END AS "supplierID",
         s_name AS name,
         CASE WHEN s_suppkey % 11 <> 0 THEN 'City ' || CAST(s_suppkey AS VARCHAR) END AS city,
         n_name AS country,
         CASE s_suppkey % 4 WHEN 0 THEN 'Small' WHEN 1 THEN 'Medium' WHEN 2 THEN 'Large' ELSE 'Extra Large' END AS size,
         CAST(s_suppkey % 180 AS DOUBLE) - 89.5 AS latitude,
         CAST(s_suppkey * 7 % 360 AS DOUBLE) - 179.5 AS longitude
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""

SUPPLIERS = """
suppliers AS (
  SELECT p_partkey AS "supplierID", p_name AS name, p_type AS ingredient, p_size % 2 = 0 AS approved
  FROM part
)"""

SILVER_TRANSACTIONS = """
silver_transactions AS (
  SELECT "transactionID", "customerID", "franchiseID", "dateTime" AS transaction_timestamp, product, quantity,
         "unitPrice", "totalPrice", "paymentMethod" AS payment_method_raw,
         'sales_transactions' AS _source_table,
         CAST("dateTime" AS DATE) AS transaction_date,
         CAST(hour("dateTime") AS INTEGER) AS transaction_hour,
         CAST(dayofweek("dateTime") + 1 AS INTEGER) AS day_of_week,
         dayofweek("dateTime") IN (0, 6) AS is_weekend,
         upper(trim("paymentMethod")) AS payment_method_clean,
         '****-****-****-' || right(CAST("cardNumber" AS VARCHAR), 4) AS card_number_masked
  FROM transactions
  WHERE "transactionID" IS NOT NULL AND "customerID" IS NOT NULL AND "franchiseID" IS NOT NULL
    AND quantity > 0 AND "totalPrice" > 0
)"""

SILVER_CUSTOMERS = """
silver_customers AS (
  SELECT *, 'sales_customers' AS _source_table,
         concat_ws(' ', first_name, last_name) AS full_name,
         upper(trim(country)) AS country_clean, upper(trim(state)) AS state_clean,
         CASE continent WHEN 'North America' THEN 'NA' WHEN 'Europe' THEN 'EU' WHEN 'Asia' THEN 'APAC'
              ELSE 'OTHER' END AS region
  FROM customers
  WHERE "customerID" IS NOT NULL AND email_address IS NOT NULL AND email_address LIKE '%@%'
)"""

SILVER_FRANCHISES = """
silver_franchises AS (
  SELECT f.*, 'sales_franchises' AS _source_table,
         s.name AS supplier_name, s.ingredient AS primary_ingredient, s.approved AS supplier_approved,
         CASE size WHEN 'Small' THEN 'S' WHEN 'Medium' THEN 'M' WHEN 'Large' THEN 'L' ELSE 'Unknown' END AS size_category
  FROM franchises f LEFT JOIN suppliers s ON f."supplierID" = s."supplierID"
)"""


def with_tables(body: str, *tables: str) -> str:
    """A SELECT over the named CTE texts, given in the order they build on each other."""
    return "WITH " + ",".join(tables) + "\n" + body


def over_sales(body: str) -> str:
    return with_tables(body, TRANSACTIONS, SILVER_TRANSACTIONS)
