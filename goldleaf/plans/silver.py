"""Silver: cleaned and checked rows. Nothing here groups; only franchises need a join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from goldleaf.functions import calendar, text
from goldleaf.operators.expectations import (
    CUSTOMER_RULES,
    FRANCHISE_RULES,
    TRANSACTION_RULES,
    drop_violations,
    warn_violations,
)


def clean_transactions(bronze: DataFrame) -> DataFrame:
    """Calendar parts, standard payment names and masked cards; every row is kept."""
    sold_at = F.col("dateTime")
    # The names of the derived columns here and below.
    derived = {
        "transaction_date": F.to_date(sold_at),
        "transaction_hour": F.hour(sold_at),
        "day_of_week": F.dayofweek(sold_at),
        "is_weekend": calendar.is_weekend_day(F.dayofweek(sold_at)),
        "payment_method_clean": text.standardize(F.col("paymentMethod")),
        "card_number_masked": text.mask_card(F.col("cardNumber")),
    }
    renamed = {"dateTime": "transaction_timestamp", "paymentMethod": "payment_method_raw"}
    return bronze.withColumns(derived).drop("cardNumber").withColumnsRenamed(renamed)


def silver_transactions(bronze: DataFrame) -> DataFrame:
    return drop_violations(clean_transactions(bronze), TRANSACTION_RULES)


def clean_customers(bronze: DataFrame) -> DataFrame:
    """Full name, standard place names and sales region; every row is kept."""
    return bronze.withColumns(
        {
            "full_name": text.full_name(F.col("first_name"), F.col("last_name")),
            "country_clean": text.standardize(F.col("country")),
            "state_clean": text.standardize(F.col("state")),
            "region": text.sales_region(F.col("continent")),
        }
    )


def silver_customers(bronze: DataFrame) -> DataFrame:
    return drop_violations(clean_customers(bronze), CUSTOMER_RULES)


def with_supplier(franchises: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Each franchise with its supplier's name, ingredient and approval, if the supplier is known.

    No broadcast hint: Spark broadcasts the suppliers while their measured size is below its
    threshold and otherwise sort-merges, where adaptive execution splits a supplier that serves
    a large part of all franchises.
    """
    about_supplier = suppliers.select(
        "supplierID",
        F.col("name").alias("supplier_name"),
        F.col("ingredient").alias("primary_ingredient"),
        F.col("approved").alias("supplier_approved"),
    )
    return franchises.join(about_supplier, "supplierID", "left")


def silver_franchises(
    franchises: DataFrame, suppliers: DataFrame, observation: Observation | None = None
) -> DataFrame:
    """Bad franchises are only warned about, never dropped."""
    sized = with_supplier(franchises, suppliers).withColumn("size_category", text.size_code(F.col("size")))
    return warn_violations(sized, FRANCHISE_RULES, observation)
