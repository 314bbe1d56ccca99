"""The domain tables, derived by fixed rules from the supplied order and event tables.

Each function returns a lazy plan over whole tables. The supplied rows are all clean, so a few
arithmetic rules plant missing ids, zero quantities, negative totals and unmatched keys; prices
are whole numbers and fares are eighths, so sums do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.plans.trip_features import model_inputs
from goldleaf.schemas import FEATURE_COLUMNS


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _hours(count: Column) -> Column:
    return F.make_dt_interval(F.lit(0), count.cast("int"))


def _every(column: str, step: int, rest: int = 0) -> Column:
    return F.col(column) % step == rest


def sales_lines(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """Transactions from order lines; also used with a streamed ``lineitem``."""
    # what a line says by itself is taken before the joins, and the part's number stays behind at the first: less is moved
    total = F.floor("l_extendedprice")
    refund = _every("l_suppkey", 53) & (F.col("l_linenumber") == 1)
    lines = lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
        F.when(_every("l_partkey", 101), F.lit(0)).otherwise(F.col("l_quantity")).cast("long").alias("quantity"),
        F.when(refund, -total).otherwise(total).alias("totalPrice"),
    )
    heads = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    goods = part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("product"), F.floor("p_retailprice").alias("unitPrice"))
    return (
        lines.join(goods, "l_partkey")
        .drop("l_partkey")
        .join(heads, "l_orderkey")
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transactionID"),
            # some customers and one franchise never sell: the rows that would name them name nobody
            F.when(~_every("l_orderkey", 97) & ~_every("o_custkey", 41), F.col("o_custkey")).alias("customerID"),
            F.when(F.col("l_suppkey") != 7, F.col("l_suppkey")).alias("franchiseID"),
            (
                F.col("l_shipdate") + _hours((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3) % 24)
            ).alias("dateTime"),
            "product",
            "quantity",
            "unitPrice",
            "totalPrice",
            F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" ")).alias("paymentMethod"),
            F.when(
                ~_every("l_orderkey", 89),
                F.lit(4000000000000000) + F.col("l_orderkey") * 1000 + F.col("l_linenumber"),
            ).alias("cardNumber"),
        )
    )


def sales_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return sales_lines(
        table(spark, folder, "lineitem"), table(spark, folder, "orders"), table(spark, folder, "part")
    )


def _places(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """Nation and continent under the key name of the joining table."""
    nation = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias(key), "n_name", F.col("n_regionkey").alias("r_regionkey")
    )
    return nation.join(table(spark, folder, "region"), "r_regionkey").select(key, "n_name", "r_name")


def sales_customers(spark: SparkSession, folder: str) -> DataFrame:
    # Continents as the sales tables spell them.
    continent = (
        F.when(F.col("r_name") == "AMERICA", "North America")
        .when(F.col("r_name") == "EUROPE", "Europe")
        .when(F.col("r_name") == "ASIA", "Asia")
        .otherwise(F.col("r_name"))
    )
    number = F.substring("c_name", 10, 9)
    email = F.when(_every("c_custkey", 17), F.concat(F.lit("no-address-"), number)).otherwise(
        F.concat(F.lit("c"), number, F.lit("@example.com"))
    )
    customers = table(spark, folder, "customer").join(_places(spark, folder, "c_nationkey"), "c_nationkey")
    return customers.select(
        F.col("c_custkey").alias("customerID"),
        F.when(~_every("c_custkey", 19), F.lit("Customer")).alias("first_name"),
        number.alias("last_name"),
        F.when(~_every("c_custkey", 13), email).alias("email_address"),
        F.concat(F.lit(" "), F.lower("n_name")).alias("country"),
        F.lower("c_mktsegment").alias("state"),
        continent.alias("continent"),
    )


def sales_franchises(spark: SparkSession, folder: str) -> DataFrame:
    shops = table(spark, folder, "supplier").join(_places(spark, folder, "s_nationkey"), "s_nationkey")
    # Size names by key, one of them without a code.
    sizes = F.array(*map(F.lit, ("Small", "Medium", "Large", "Extra Large")))
    return shops.select(
        F.col("s_suppkey").alias("franchiseID"),
        F.when(_every("s_suppkey", 10, 9), -F.col("s_suppkey")).otherwise(F.col("s_suppkey")).alias("supplierID"),
        F.col("s_name").alias("name"),
        F.when(~_every("s_suppkey", 11), F.concat(F.lit("City "), F.col("s_suppkey").cast("string"))).alias("city"),
        F.col("n_name").alias("country"),
        sizes[(F.col("s_suppkey") % 4).cast("int")].alias("size"),
        (F.col("s_suppkey") % 180 - 89.5).alias("latitude"),
        (F.col("s_suppkey") * 7 % 360 - 179.5).alias("longitude"),
    )


def sales_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("supplierID"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("ingredient"),
        _every("p_size", 2).alias("approved"),
    )


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Taxi-like trips from events, with the event number as an extra column. Some have no pickup time."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("trip_id"),
        F.when(~_every("event_id", 101, 7), F.col("ts")).alias("tpep_pickup_datetime"),
        (F.get_json_object("props", "$.k").cast("double") / 4).alias("trip_distance"),
        (F.floor(F.col("value") * 8) / 8).alias("fare_amount"),
    )


def trip_inputs(spark: SparkSession, folder: str) -> DataFrame:
    """Model inputs of all trips, also invalid ones, with trip number and pickup time."""
    return trips(spark, folder).select("trip_id", "tpep_pickup_datetime", *model_inputs())


CALL_SIZE = 5


def payload_log(spark: SparkSession, folder: str) -> DataFrame:
    """A log of model calls: five consecutive trips per call, rendered in four encodings by turns.

    Fixed call numbers fail, are cut short, are missing, carry no records, carry an hour in quotes,
    answer one prediction too few, or answer with text instead of the second prediction.
    """
    inputs = trip_inputs(spark, folder).withColumn("request_id", F.expr(f"trip_id div {CALL_SIZE}"))
    # a given number of parts: the calls are few bytes but much work, and by size a few tasks would get them all
    inputs = inputs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "request_id")
    calls = inputs.groupBy("request_id").agg(
        F.min("tpep_pickup_datetime").alias("request_time"),
        # at most CALL_SIZE records per call
        F.sort_array(F.collect_list(F.struct("trip_id", *FEATURE_COLUMNS))).alias("calls"),
    )
    record = F.transform("calls", lambda call: F.struct(*(call[name].alias(name) for name in FEATURE_COLUMNS)))
    records = F.to_json(record)
    names = F.to_json(F.array(*map(F.lit, FEATURE_COLUMNS)))
    quoted = (F.col("request_id") % 4 == 1) & _every("request_id", 241, 17)

    def cell(call: Column, name: str) -> Column:
        text = F.coalesce(call[name].cast("string"), F.lit("null"))
        return F.when(quoted, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(text) if name == "pickup_hour" else text

    rows = F.transform(
        "calls", lambda call: F.concat(F.lit("["), F.concat_ws(",", *(cell(call, name) for name in FEATURE_COLUMNS)), F.lit("]"))
    )
    table = F.concat(F.lit('{"columns":'), names, F.lit(',"data":['), F.concat_ws(",", rows), F.lit("]}"))
    form = F.col("request_id") % 4
    body = (
        F.when(form == 0, F.concat(F.lit('{"dataframe_records":'), records, F.lit("}")))
        .when(form == 1, F.concat(F.lit('{"dataframe_split":'), table, F.lit("}")))
        .when(form == 2, F.concat(F.lit('{"instances":'), records, F.lit("}")))
        .otherwise(F.concat(F.lit('{"inputs":'), records, F.lit("}")))
    )
    request = (
        F.when(_every("request_id", 211, 3), F.concat(F.lit('{"inputs":[{"trip_dist'), F.col("request_id").cast("string")))
        .when(_every("request_id", 223, 5), F.lit(None))
        .when(_every("request_id", 227, 7), F.lit("{}"))
        .otherwise(body)
    )
    fares = F.transform("calls", lambda call: F.lit(3.0) + F.lit(2.5) * call["trip_distance"])
    answered = F.when(_every("request_id", 229, 11), F.slice(fares, 1, CALL_SIZE - 1)).otherwise(fares)
    wrong = _every("request_id", 233, 13)
    values = F.transform(answered, lambda fare, i: F.when(wrong & (i == 1), F.lit('"n/a"')).otherwise(fare.cast("string")))
    response = F.concat(F.lit('{"predictions":['), F.concat_ws(",", values), F.lit("]}"))
    return calls.select(
        "request_id",
        request.alias("request"),
        response.alias("response"),
        F.when(_every("request_id", 50), "500").otherwise("200").alias("status_code"),
        "request_time",
        F.when(F.col("request_id") % 3 != 2, F.lit("fare-model-1")).alias("served_entity_id"),
    )
