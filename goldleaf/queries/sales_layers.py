"""Bronze and silver datasets, and their column rules one by one."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldleaf.functions import calendar, text
from goldleaf.operators import audit, expectations
from goldleaf.plans import bronze, silver
from goldleaf.queries.common import (
    CUSTOMERS,
    FRANCHISES,
    SILVER_CUSTOMERS,
    SILVER_FRANCHISES,
    SUPPLIERS,
    TRANSACTIONS,
    naive_times,
    over_sales,
    query,
    silver_buyers,
    silver_sales,
    silver_shops,
    with_tables,
)
from goldleaf.sources import sample_tables as sample


def _bronze(build):
    return naive_times(build.drop("_ingested_at"))


@query(
    "bronze_transactions",
    with_tables("SELECT *, 'sales_transactions' AS _source_table FROM transactions", TRANSACTIONS),
)
def _(spark, folder):
    return _bronze(bronze.bronze_transactions(sample.sales_transactions(spark, folder)))


@query("bronze_customers", with_tables("SELECT *, 'sales_customers' AS _source_table FROM customers", CUSTOMERS))
def _(spark, folder):
    return _bronze(bronze.bronze_customers(sample.sales_customers(spark, folder)))


@query("bronze_franchises", with_tables("SELECT *, 'sales_franchises' AS _source_table FROM franchises", FRANCHISES))
def _(spark, folder):
    return _bronze(bronze.bronze_franchises(sample.sales_franchises(spark, folder)))


@query("bronze_suppliers", with_tables("SELECT *, 'sales_suppliers' AS _source_table FROM suppliers", SUPPLIERS))
def _(spark, folder):
    return _bronze(bronze.bronze_suppliers(sample.sales_suppliers(spark, folder)))


@query(
    "audit_columns",
    """SELECT s_suppkey, s_name, 'supplier' AS _source_table, TRUE AS ingested_today FROM supplier""",
)
def _(spark, folder):
    stamped = audit.with_audit(sample.table(spark, folder, "supplier"), "supplier")
    today = F.to_date(audit.INGESTED_AT) == F.current_date()
    return stamped.select("s_suppkey", "s_name", audit.SOURCE_TABLE, today.alias("ingested_today"))


@query("silver_transactions", over_sales("SELECT * FROM silver_transactions"))
def _(spark, folder):
    return naive_times(silver_sales(spark, folder))


@query("silver_customers", with_tables("SELECT * FROM silver_customers", CUSTOMERS, SILVER_CUSTOMERS))
def _(spark, folder):
    return silver_buyers(spark, folder)


@query(
    "silver_franchises", with_tables("SELECT * FROM silver_franchises", FRANCHISES, SUPPLIERS, SILVER_FRANCHISES)
)
def _(spark, folder):
    return silver_shops(spark, folder)


@query(
    "left_broadcast_join",
    with_tables(
        """SELECT f."franchiseID", f.name, s.name AS supplier_name, s.ingredient AS primary_ingredient,
                  s.approved AS supplier_approved
           FROM franchises f LEFT JOIN suppliers s ON f."supplierID" = s."supplierID" """,
        FRANCHISES,
        SUPPLIERS,
    ),
)
def _(spark, folder):
    shops = sample.sales_franchises(spark, folder)
    joined = silver.with_supplier(shops, sample.sales_suppliers(spark, folder))
    return joined.select("franchiseID", "name", "supplier_name", "primary_ingredient", "supplier_approved")


@query(
    "date_parts",
    with_tables(
        """SELECT "transactionID", "franchiseID", CAST("dateTime" AS DATE) AS sold_on, CAST(hour("dateTime") AS INTEGER) AS sold_hour,
                  CAST(dayofweek("dateTime") + 1 AS INTEGER) AS sold_weekday, CAST(month("dateTime") AS INTEGER) AS sold_month,
                  dayofweek("dateTime") IN (0, 6) AS on_weekend FROM transactions""",
        TRANSACTIONS,
    ),
)
def _(spark, folder):
    at = F.col("dateTime")
    return sample.sales_transactions(spark, folder).select(
        "transactionID",
        "franchiseID",
        F.to_date(at).alias("sold_on"),
        F.hour(at).alias("sold_hour"),
        F.dayofweek(at).alias("sold_weekday"),
        F.month(at).alias("sold_month"),
        calendar.is_weekend_day(F.dayofweek(at)).alias("on_weekend"),
    )


@query(
    "standardize_text",
    with_tables('SELECT "transactionID", product, upper(trim("paymentMethod")) AS payment_method_clean FROM transactions', TRANSACTIONS),
)
def _(spark, folder):
    cleaned = text.standardize(F.col("paymentMethod")).alias("payment_method_clean")
    return sample.sales_transactions(spark, folder).select("transactionID", "product", cleaned)


@query(
    "mask_card",
    with_tables(
        """SELECT "transactionID", "franchiseID", '****-****-****-' || right(CAST("cardNumber" AS VARCHAR), 4) AS card_number_masked
           FROM transactions""",
        TRANSACTIONS,
    ),
)
def _(spark, folder):
    masked = text.mask_card(F.col("cardNumber"))
    sales = sample.sales_transactions(spark, folder).select("transactionID", "franchiseID", "cardNumber")
    return sales.withColumn("card_number_masked", masked).drop("cardNumber")


@query(
    "region_segment",
    with_tables(
        """SELECT "customerID", continent, CASE continent WHEN 'North America' THEN 'NA' WHEN 'Europe' THEN 'EU'
                  WHEN 'Asia' THEN 'APAC' ELSE 'OTHER' END AS region FROM customers""",
        CUSTOMERS,
    ),
)
def _(spark, folder):
    region = text.sales_region(F.col("continent")).alias("region")
    return sample.sales_customers(spark, folder).select("customerID", "continent", region)


@query(
    "size_category",
    with_tables(
        """SELECT "franchiseID", size, CASE size WHEN 'Small' THEN 'S' WHEN 'Medium' THEN 'M' WHEN 'Large' THEN 'L'
                  ELSE 'Unknown' END AS size_category FROM franchises""",
        FRANCHISES,
    ),
)
def _(spark, folder):
    code = text.size_code(F.col("size")).alias("size_category")
    return sample.sales_franchises(spark, folder).select("franchiseID", "size", code)


@query(
    "expect_drop_transactions",
    with_tables(
        """SELECT "transactionID", "customerID", "franchiseID", quantity, "totalPrice" FROM transactions
           WHERE "customerID" IS NOT NULL AND "franchiseID" IS NOT NULL AND quantity > 0 AND "totalPrice" > 0""",
        TRANSACTIONS,
    ),
)
def _(spark, folder):
    sales = sample.sales_transactions(spark, folder)
    kept = expectations.drop_violations(sales, expectations.TRANSACTION_RULES)
    return kept.select("transactionID", "customerID", "franchiseID", "quantity", "totalPrice")


@query(
    "expect_drop_customers",
    with_tables("""SELECT "customerID", email_address FROM customers WHERE email_address LIKE '%@%'""", CUSTOMERS),
)
def _(spark, folder):
    customers = sample.sales_customers(spark, folder)
    kept = expectations.drop_violations(customers, expectations.CUSTOMER_RULES)
    return kept.select("customerID", "email_address")


@query(
    "expect_warn_franchises",
    with_tables(
        """SELECT "franchiseID", city, country, CASE WHEN city IS NULL THEN 'valid_location' ELSE '' END AS warnings
           FROM franchises""",
        FRANCHISES,
    ),
)
def _(spark, folder):
    shops = sample.sales_franchises(spark, folder).select("franchiseID", "city", "country")
    kept = expectations.warn_violations(shops, expectations.FRANCHISE_RULES)
    return kept.withColumn("warnings", F.concat_ws(",", expectations.violated_rules(expectations.FRANCHISE_RULES)))


@query(
    "expect_fail_clean_input",
    over_sales('SELECT "transactionID", "franchiseID", quantity FROM silver_transactions'),
)
def _(spark, folder):
    rules = {
        "still_positive": "quantity > 0 AND totalPrice > 0",
        "masked": "card_number_masked IS NULL OR card_number_masked LIKE '****-****-****-%'",
    }
    checked = expectations.fail_on_violation(silver_sales(spark, folder), rules)
    return checked.select("transactionID", "franchiseID", "quantity")


_REPORT_SQL = with_tables(
    """
SELECT 'silver_transactions' AS dataset, rule, 'drop' AS action,
       CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS passed,
       CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT) AS failed
FROM (
  SELECT 'valid_transaction_id' AS rule, "transactionID" IS NOT NULL AS ok FROM transactions
  UNION ALL SELECT 'valid_customer_id', "customerID" IS NOT NULL FROM transactions
  UNION ALL SELECT 'valid_franchise_id', "franchiseID" IS NOT NULL FROM transactions
  UNION ALL SELECT 'positive_quantity', quantity > 0 FROM transactions
  UNION ALL SELECT 'positive_total', "totalPrice" > 0 FROM transactions
) GROUP BY rule
UNION ALL
SELECT 'silver_customers', rule, 'drop', CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT),
       CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT)
FROM (
  SELECT 'valid_customer_id' AS rule, "customerID" IS NOT NULL AS ok FROM customers
  UNION ALL SELECT 'valid_email', email_address IS NOT NULL AND email_address LIKE '%@%' FROM customers
) GROUP BY rule
UNION ALL
SELECT 'silver_franchises', rule, 'warn', CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT),
       CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT)
FROM (
  SELECT 'valid_franchise_id' AS rule, "franchiseID" IS NOT NULL AS ok FROM franchises
  UNION ALL SELECT 'valid_location', city IS NOT NULL AND country IS NOT NULL FROM franchises
) GROUP BY rule
""",
    TRANSACTIONS,
    CUSTOMERS,
    FRANCHISES,
)


@query("expectation_report", _REPORT_SQL)
def _(spark, folder):
    guarded = [
        (sample.sales_transactions, "silver_transactions", expectations.TRANSACTION_RULES, "drop"),
        (sample.sales_customers, "silver_customers", expectations.CUSTOMER_RULES, "drop"),
        (sample.sales_franchises, "silver_franchises", expectations.FRANCHISE_RULES, "warn"),
    ]
    reports = [
        expectations.expectation_report(source(spark, folder), dataset, rules, action)
        for source, dataset, rules, action in guarded
    ]
    return reports[0].union(reports[1]).union(reports[2])
