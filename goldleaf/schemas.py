"""Column contracts of the six input tables and of the logged model payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TRANSACTIONS = _struct(
    transactionID=T.LongType(),
    customerID=T.LongType(),
    franchiseID=T.LongType(),
    dateTime=T.TimestampType(),
    product=T.StringType(),
    quantity=T.LongType(),
    unitPrice=T.LongType(),
    totalPrice=T.LongType(),
    paymentMethod=T.StringType(),
    cardNumber=T.LongType(),
)

CUSTOMERS = _struct(
    customerID=T.LongType(),
    first_name=T.StringType(),
    last_name=T.StringType(),
    email_address=T.StringType(),
    country=T.StringType(),
    state=T.StringType(),
    continent=T.StringType(),
)

FRANCHISES = _struct(
    franchiseID=T.LongType(),
    supplierID=T.LongType(),
    name=T.StringType(),
    city=T.StringType(),
    country=T.StringType(),
    size=T.StringType(),
    latitude=T.DoubleType(),
    longitude=T.DoubleType(),
)

SUPPLIERS = _struct(
    supplierID=T.LongType(),
    name=T.StringType(),
    ingredient=T.StringType(),
    approved=T.BooleanType(),
)

TRIPS = _struct(
    tpep_pickup_datetime=T.TimestampType(),
    trip_distance=T.DoubleType(),
    fare_amount=T.DoubleType(),
)

PAYLOAD_LOG = _struct(
    request=T.StringType(),
    response=T.StringType(),
    status_code=T.StringType(),
    request_time=T.TimestampType(),
    served_entity_id=T.StringType(),
)

# The columns of the gold tables, in order.
DAILY_SALES_COLUMNS = (
    "transaction_date", "franchiseID", "total_revenue", "transaction_count", "avg_transaction_value",
    "unique_customers", "total_items_sold", "unique_products_sold",
)
CUSTOMER_COLUMNS = (
    "customerID", "full_name", "email_address", "region", "country_clean", "lifetime_value", "total_transactions",
    "avg_transaction_value", "first_purchase_date", "last_purchase_date", "customer_tenure_days",
    "purchase_frequency", "franchises_visited",
)
PRODUCT_COLUMNS = (
    "product", "total_units_sold", "total_revenue", "transaction_count", "avg_unit_price",
    "avg_quantity_per_transaction", "franchise_count", "unique_customers", "revenue_per_unit",
)
FRANCHISE_COLUMNS = (
    "franchiseID", "name", "city", "country", "size_category", "supplier_name", "primary_ingredient",
    "total_revenue", "total_transactions", "avg_transaction_value", "unique_customers",
    "avg_items_per_transaction", "peak_hour", "weekend_revenue_pct", "latitude", "longitude",
)

# The model's inputs, its label and its output.
FEATURE_COLUMNS = (
    "trip_distance",
    "pickup_hour",
    "pickup_dayofweek",
    "pickup_month",
    "is_weekend",
    "is_rush_hour",
)
LABEL = "fare_amount"
PREDICTION = "predicted_fare"

# What one logged request record and one logged response record hold.
REQUEST_RECORD = T.StructType(
    [
        T.StructField(name, T.FloatType() if name == "trip_distance" else T.IntegerType())
        for name in FEATURE_COLUMNS
    ]
)
RESPONSE_RECORD = _struct(**{PREDICTION: T.FloatType()})


def _family(kind: T.DataType) -> str:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    if isinstance(kind, T.NumericType):
        return "number"
    return kind.typeName()


def require_columns(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Fail before any work starts when an input lacks a column or holds another kind of value.

    Extra columns pass through: layers inherit whatever the source carries. Number widths may
    differ from the contract, and both timestamp kinds are accepted.
    """
    present = {field.name: field.dataType for field in df.schema.fields}
    missing = [field.name for field in contract.fields if field.name not in present]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    other = [
        f"{field.name}: {present[field.name].simpleString()}"
        for field in contract.fields
        if _family(present[field.name]) != _family(field.dataType)
    ]
    if other:
        raise ValueError(f"unexpected column types: {other}")
    return df
