from datetime import date, datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from goldleaf.functions import text
from goldleaf.operators.expectations import (
    CUSTOMER_RULES,
    FRANCHISE_RULES,
    TRANSACTION_RULES,
    drop_violations,
    expectation_report,
    fail_on_violation,
    warn_violations,
)
from goldleaf.plans import bronze, silver

SALE = (
    "transactionID long, customerID long, franchiseID long, dateTime timestamp, product string, quantity long, "
    "unitPrice long, totalPrice long, paymentMethod string, cardNumber long"
)


def sale(at=datetime(2024, 5, 15, 14, 30), method="visa", card=4000111122223333, **ids):
    keys = {"transaction": 1, "customer": 100, "franchise": 200, **ids}
    return (keys["transaction"], keys["customer"], keys["franchise"], at, "Ginger", 5, 10, 50, method, card)


def test_calendar_parts(spark):
    row = silver.silver_transactions(spark.createDataFrame([sale()], SALE)).first()
    assert (row.transaction_date, row.transaction_hour, row.day_of_week) == (date(2024, 5, 15), 14, 4)


@pytest.mark.parametrize("day, weekend", [(11, True), (12, True), (13, False)])
def test_weekend(spark, day, weekend):
    sold = spark.createDataFrame([sale(datetime(2024, 5, day, 10))], SALE)
    assert silver.silver_transactions(sold).first().is_weekend is weekend


def test_unknown_time_is_no_weekend(spark):
    assert silver.silver_transactions(spark.createDataFrame([sale(at=None)], SALE)).first().is_weekend is False


def test_payment_names_and_renames(spark):
    sold = spark.createDataFrame([sale(method=m) for m in ("  visa  ", "MasterCard", "AMEX", None)], SALE)
    cleaned = silver.silver_transactions(sold)
    assert [r.payment_method_clean for r in cleaned.collect()] == ["VISA", "MASTERCARD", "AMEX", None]
    assert "payment_method_raw" in cleaned.columns and "transaction_timestamp" in cleaned.columns
    assert not {"cardNumber", "dateTime", "paymentMethod"} & set(cleaned.columns)


def test_card_mask(spark):
    cards = [4000111122223333, 4000999988887777, 123, None]
    sold = spark.createDataFrame([sale(card=c) for c in cards], SALE)
    masked = [r.card_number_masked for r in silver.silver_transactions(sold).collect()]
    assert masked == ["****-****-****-3333", "****-****-****-7777", "****-****-****-123", None]


QUALITY = [
    (11, 7, 31, 2, 18),
    (None, 7, 31, 2, 18),
    (12, None, 31, 2, 18),
    (13, 7, None, 2, 18),
    # Zero and below zero are the bounds of the two rules.
    (14, 7, 31, 0, 18),
    (15, 7, 31, 2, -1),
]
QUALITY_SCHEMA = "transactionID long, customerID long, franchiseID long, quantity long, totalPrice long"


def test_quality_rules_drop_every_violation(spark):
    kept = drop_violations(spark.createDataFrame(QUALITY, QUALITY_SCHEMA), TRANSACTION_RULES)
    assert [r.transactionID for r in kept.collect()] == [11]


def test_null_rule_counts_as_violation(spark):
    df = spark.createDataFrame([(1, 100, 200, None, 50), (2, 100, 200, 5, 50)], QUALITY_SCHEMA)
    assert [r.transactionID for r in drop_violations(df, TRANSACTION_RULES).collect()] == [2]
    report = {r.rule: (r.passed, r.failed) for r in expectation_report(df, "t", TRANSACTION_RULES, "drop").collect()}
    assert report["positive_quantity"] == (1, 1)
    assert report["positive_total"] == (2, 0)


def test_report_of_empty_input(spark):
    df = spark.createDataFrame([], QUALITY_SCHEMA)
    assert {(r.passed, r.failed) for r in expectation_report(df, "t", TRANSACTION_RULES, "drop").collect()} == {(0, 0)}


def test_customer_fields(spark, rows):
    schema = "customerID long, first_name string, last_name string, email_address string, country string, state string, continent string"
    people = [
        (1, "Ada", "Moor", "ada@moor.example", " us ", "tx", "North America"),
        (2, "Ben", "Hill", "no address", "de", "be", "Europe"),
        (3, None, "Reed", "reed@pond.example", "jp", None, "Asia"),
        (4, "No", "Mail", None, "br", "sp", "South America"),
        (None, "No", "Id", "a@b", "ng", "la", "Africa"),
    ]
    df = spark.createDataFrame(people, schema)
    kept = silver.silver_customers(bronze.bronze_customers(df))
    assert rows(kept, "customerID", "full_name", "country_clean", "state_clean", "region") == [
        (1, "Ada Moor", "US", "TX", "NA"),
        (3, "Reed", "JP", None, "APAC"),
    ]
    assert df.filter(CUSTOMER_RULES["valid_email"]).count() == 3


@pytest.mark.parametrize(
    "continent, region",
    [("North America", "NA"), ("Europe", "EU"), ("Asia", "APAC"), ("South America", "OTHER"), ("Africa", "OTHER"), ("asia", "OTHER"), (None, "OTHER")],
)
def test_region(spark, continent, region):
    df = spark.createDataFrame([(continent,)], "continent string")
    assert df.select(text.sales_region(F.col("continent"))).first()[0] == region


@pytest.mark.parametrize(
    "size, code",
    [("Small", "S"), ("Medium", "M"), ("Large", "L"), ("Extra Large", "Unknown"), (None, "Unknown")],
)
def test_size(spark, size, code):
    df = spark.createDataFrame([(size,)], "size string")
    assert df.select(text.size_code(F.col("size"))).first()[0] == code


SHOPS = [
    (1, 10, "A", "Austin", "US", "Small", 1.0, 2.0),
    (2, 99, "B", None, "US", "Large", 1.0, 2.0),
    (None, 10, "C", "Rome", "IT", None, 1.0, 2.0),
]
SHOP_SCHEMA = "franchiseID long, supplierID long, name string, city string, country string, size string, latitude double, longitude double"


def silver_shops(spark, observation=None):
    suppliers = spark.createDataFrame([(10, "Mill", "flour", True)], "supplierID long, name string, ingredient string, approved boolean")
    return silver.silver_franchises(spark.createDataFrame(SHOPS, SHOP_SCHEMA), suppliers, observation)


def test_unmatched_supplier_and_bad_rows_stay(spark, rows):
    assert rows(silver_shops(spark), "franchiseID", "supplier_name", "supplier_approved", "size_category") == [
        (1, "Mill", True, "S"),
        (2, None, None, "L"),
        (None, "Mill", True, "Unknown"),
    ]


def test_warnings_are_counted_in_passing(spark):
    seen = Observation("franchises")
    assert silver_shops(spark, seen).count() == 3
    assert seen.get == {"rows": 3, "valid_franchise_id": 1, "valid_location": 1}
    untouched = spark.createDataFrame(SHOPS, SHOP_SCHEMA)
    assert warn_violations(untouched, FRANCHISE_RULES) is untouched


def test_fail_stops_on_a_bad_row(spark):
    rule = {"positive_quantity": "quantity > 0"}
    good = spark.createDataFrame(QUALITY[:1], QUALITY_SCHEMA)
    assert fail_on_violation(good, rule).count() == 1
    with pytest.raises(Exception, match="positive_quantity"):
        fail_on_violation(spark.createDataFrame(QUALITY, QUALITY_SCHEMA), rule).select("transactionID").collect()


def test_bronze_audit_and_contract(spark):
    taken = bronze.bronze_transactions(spark.createDataFrame([sale()], SALE), "shop.sales")
    assert taken.columns[-2:] == ["_ingested_at", "_source_table"]
    assert taken.first()._source_table == "shop.sales"
    with pytest.raises(ValueError, match="missing"):
        bronze.bronze_transactions(spark.createDataFrame([(1,)], "transactionID long"))
    with pytest.raises(ValueError, match="types"):
        bronze.bronze_suppliers(spark.createDataFrame([("x", "n", "i", True)], "supplierID string, name string, ingredient string, approved boolean"))
