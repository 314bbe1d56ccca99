import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from goldleaf.plans import refresh
from goldleaf.session import CHECKPOINT_SETTING, run_folder, shared_folder
from goldleaf.sources import files, tables
from goldleaf.sources import sample_tables as sample
from goldleaf.streaming import ingest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def place(spark):
    schema, folder = f"t_{uuid.uuid4().hex[:10]}", run_folder(spark, "test")
    tables.create_schema(spark, schema, folder)
    return schema, folder


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get(CHECKPOINT_SETTING).rstrip("/")
    assert run_folder(spark, "x") != run_folder(spark, "x")


def test_table_properties_comment_and_partitions(spark, place):
    schema, folder = place
    layout = tables.Layout("It's a test", {"quality": "gold"}, partition_by=("o_orderpriority",))
    orders = sample.table(spark, SMALL, "orders")
    stored = tables.overwrite_table(orders, f"{schema}.orders", f"{folder}/orders", layout)
    assert stored.count() == orders.count()
    assert "o_orderpriority" in stored.columns
    shown = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {schema}.orders").collect()}
    assert shown["quality"] == "gold"
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {schema}.orders").collect()}
    assert described["Comment"] == "It's a test"
    one = stored.filter(F.col("o_orderpriority") == "5-LOW")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(o_orderpriority" in plan


def test_overwrite_replaces_the_schema(spark, place):
    schema, folder = place
    first = spark.range(5).withColumn("old", F.lit(1))
    tables.overwrite_table(first, f"{schema}.t", f"{folder}/t")
    stored = tables.overwrite_table(spark.range(3).withColumn("new", F.lit("x")), f"{schema}.t", f"{folder}/t")
    assert stored.columns == ["id", "new"] and stored.count() == 3


def test_gathered_values_lie_in_few_files(spark, place):
    schema, folder = place
    df = spark.range(20_000).withColumn("day", (F.col("id") % 40).cast("int")).repartition(8)
    layout = tables.Layout(gather_by=("day",))
    stored = tables.overwrite_table(df, f"{schema}.g", f"{folder}/g", layout)
    spread = stored.select("day", F.input_file_name().alias("f")).distinct().groupBy("day").count()
    assert spread.agg(F.max("count")).first()[0] == 1
    ranged = tables.overwrite_table(df, f"{schema}.r", f"{folder}/r", tables.Layout(range_by=("id",)))
    bounds = ranged.groupBy(F.input_file_name()).agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("a").collect()
    assert all(left.b < right.a for left, right in zip(bounds, bounds[1:]))


def test_refresh_writes_twelve_tables(spark):
    sources = refresh.SalesSources(
        sample.sales_transactions(spark, SMALL),
        sample.sales_customers(spark, SMALL),
        sample.sales_franchises(spark, SMALL),
        sample.sales_suppliers(spark, SMALL),
    )
    schema = f"t_{uuid.uuid4().hex[:10]}"
    stored = refresh.refresh_sales(spark, sources, schema, run_folder(spark, "test"))
    counts = {r.dataset: r.rows for r in refresh.row_counts(stored).collect()}
    assert set(counts) == set(refresh.LAYOUTS) and len(counts) == 12
    assert 0 < counts["silver_transactions"] < counts["bronze_transactions"]
    for name, df in stored.items():
        if not name.startswith("bronze"):
            assert "cardNumber" not in df.columns
    again = refresh.refresh_sales(spark, sources, schema, run_folder(spark, "test"))
    assert {r.dataset: r.rows for r in refresh.row_counts(again).collect()} == counts


def test_json_with_schema(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1, "b": "x"}\n{"a": "no number", "b": "y"}\nnot json\n')
    found = files.read_json(spark, str(tmp_path), "a int, b string").collect()
    assert {(r.a, r.b) for r in found} == {(1, "x"), (None, "y"), (None, None)}


def _drop_file(folder, name, ids):
    lines = [
        json.dumps(
            {
                "transactionID": k, "customerID": k % 3 or None, "franchiseID": 7, "dateTime": "2024-05-11T10:00:00", "product": "p",
                "quantity": 1, "unitPrice": 2, "totalPrice": 2, "paymentMethod": " visa", "cardNumber": 4000000000000000 + k,
            }
        )
        for k in ids
    ]
    with open(os.path.join(folder, name), "w") as out:
        out.write("\n".join(lines))


def test_stream_takes_each_file_once(spark, tmp_path):
    from goldleaf.plans import bronze, silver
    from goldleaf.schemas import TRANSACTIONS

    landing, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    landing.mkdir()

    def run():
        stream = files.stream_files(spark, str(landing), TRANSACTIONS, "json", files_per_batch=1)
        query = ingest.append_available(stream, ingest.to_silver_transactions, target, checkpoint, ["transaction_date"])
        ingest.run_to_end(query)
        return spark.read.parquet(target)

    _drop_file(landing, "1.json", range(10))
    _drop_file(landing, "2.json", range(10, 20))
    first = run().count()
    assert run().count() == first
    _drop_file(landing, "3.json", range(20, 30))
    streamed = run()
    batch = silver.silver_transactions(bronze.bronze_transactions(files.read_json(spark, str(landing), TRANSACTIONS)))
    columns = [name for name in batch.columns if name != "_ingested_at"]
    assert streamed.count() == 20
    assert streamed.select(columns).exceptAll(batch.select(columns)).count() == 0
    assert batch.select(columns).exceptAll(streamed.select(columns)).count() == 0


def test_json_lines_are_stored_compressed(spark, place):
    path = f"{place[1]}/lines"
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string")
    files.write_json(df, path)
    assert sorted(map(tuple, files.read_json(spark, path, df.schema).collect())) == [(1, "a"), (2, None)]
    assert all(name.endswith(".gz") for name in tables.folders(spark, path) if name.startswith("part-"))
