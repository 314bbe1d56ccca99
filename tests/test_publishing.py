"""Overwrites that fail, versions, partitions replaced, tracked tables, and gold brought up by changes."""

import os
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from goldleaf.plans import bronze, gold, gold_changes, refresh, silver, tracked
from goldleaf.queries import QUERIES
from goldleaf.session import run_folder
from goldleaf.sources import sample_tables as sample
from goldleaf.sources import tables




@pytest.fixture
def place(spark):
    schema, folder = f"t_{uuid.uuid4().hex[:10]}", run_folder(spark, "test")
    tables.create_schema(spark, schema, folder)
    return schema, folder


def versions(folder):
    return sorted(name for name in os.listdir(folder) if name.startswith(tables.VERSION))


def failing_in_last_task(df):
    """All tasks but the last succeed."""
    last = df.rdd.getNumPartitions() - 1
    broken = F.when(F.spark_partition_id() == last, F.raise_error(F.lit("task lost")).cast("long"))
    return df.withColumn("id", F.coalesce(broken, F.col("id")))


@pytest.mark.parametrize("layout", [tables.Layout("old", {"k": "old"}), tables.Layout("old", {"k": "old"}, partition_by=("part",))])
@pytest.mark.parametrize("other_columns", [False, True])
def test_a_failed_write_changes_nothing(spark, place, layout, other_columns):
    schema, folder = place
    name, path = f"{schema}.t", f"{folder}/t"
    rows = spark.range(0, 40, 1, 4).withColumn("part", F.col("id") % 3)
    tables.overwrite_table(rows, name, path, layout)
    new = failing_in_last_task(spark.range(100, 200, 1, 5).withColumn("part", F.lit(7).cast("long")))
    new = new.withColumn("more", F.lit("x")) if other_columns else new
    shown = spark.read.table(name)
    with pytest.raises(Exception, match="task lost"):
        tables.overwrite_table(new, name, path, tables.Layout("new", {"k": "new"}, partition_by=layout.partition_by))
    for again in (shown, spark.read.table(name)):
        assert again.columns == ["id", "part"]
        assert sorted(row[0] for row in again.select("id").collect()) == list(range(40))
    assert tables.table_property(spark, name, "k") == "old" and len(versions(path)) == 1
    assert not spark.catalog.tableExists(f"{name}__next")
    replaced = tables.overwrite_table(spark.range(3).withColumn("more", F.lit("y")), name, path, tables.Layout(properties={"k": "new"}))
    assert replaced.columns == ["id", "more"] and replaced.count() == 3 and tables.table_property(spark, name, "k") == "new"


def test_a_driver_lost_between_the_two_steps(spark, place):
    schema, folder = place
    name = f"{schema}.t"
    tables.overwrite_table(spark.range(5), name, f"{folder}/t")
    spark.range(9).withColumn("b", F.lit(1)).write.option("path", f"{folder}/t/{tables.VERSION}9-next").saveAsTable(f"{name}__next")
    spark.sql(f"DROP TABLE {name}")
    tables.finish_publishing(spark, name)
    assert spark.read.table(name).columns == ["id", "b"] and spark.read.table(name).count() == 9
    # lost before the first step: the version that was beside goes
    spark.range(1).write.option("path", f"{folder}/t/{tables.VERSION}9-other").saveAsTable(f"{name}__next")
    tables.finish_publishing(spark, name)
    assert spark.read.table(name).count() == 9 and not spark.catalog.tableExists(f"{name}__next")


def test_readers_of_the_version_before(spark, place):
    schema, folder = place
    name, path = f"{schema}.t", f"{folder}/t"
    first = tables.overwrite_table(spark.range(5), name, path)
    counted = first.agg(F.sum("id"))
    tables.overwrite_table(first.union(first), name, path)  # a table may be replaced by what is read from it
    assert counted.first()[0] == 10 and spark.read.table(name).count() == 10
    for _ in range(3):
        tables.overwrite_table(spark.range(2), name, path)
    assert len(versions(path)) == tables.KEPT_VERSIONS and spark.read.table(name).count() == 2


def test_before_publishing_can_stop_it(spark, place):
    schema, folder = place
    name, path = f"{schema}.t", f"{folder}/t"
    tables.overwrite_table(spark.range(5), name, path)

    def refuse(new):
        assert new.count() == 7 and spark.read.table(name).count() == 5
        raise ValueError("not this one")

    with pytest.raises(ValueError, match="not this one"):
        tables.overwrite_table(spark.range(7), name, path, before_publishing=refuse)
    assert spark.read.table(name).count() == 5 and len(versions(path)) == 1


def test_partitions_are_replaced_alone(spark, place):
    schema, folder = place
    name, path, layout = f"{schema}.t", f"{folder}/t", tables.Layout(partition_by=("day",))

    def days(rows):
        return tables.stored(spark.createDataFrame(rows, "n int, day date"), "test")

    one, two, three = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
    tables.replace_partitions(days([(1, one), (2, two), (3, three), (4, None)]), name, path, layout)
    at = tables.table_location(spark, name).removeprefix("file:").replace("//", "/")
    before = {day: os.listdir(f"{at}/day={day}") for day in (one, three)}
    out = tables.replace_partitions(days([(5, two), (6, two), (7, date(2024, 1, 4))]), name, path, layout, days([(0, one), (0, None)]))
    assert sorted(tuple(row) for row in out.collect()) == [(3, three), (5, two), (6, two), (7, date(2024, 1, 4))]
    assert os.listdir(f"{at}/day={three}") == before[three] and not os.path.exists(f"{at}/day={one}")
    again = tables.replace_partitions(days([(5, two), (6, two)]), name, path, layout)
    assert again.where("day = '2024-01-02'").count() == 2
    assert tables.replace_partitions(days([]), name, path, layout).count() == 4


def test_changes_are_kept_once(spark, place, monkeypatch):
    """A refresh that breaks off after writing its changes is repeated: the feed has them once, and none that never appeared."""
    schema, folder = place
    name, path, layout = f"{schema}.t", f"{folder}/t", tables.Layout(properties={"changes": "tracked"})
    rows = spark.range(10).withColumn("v", F.col("id") * 2)
    tracked.overwrite_tracked(rows, name, path, layout, ["id"])
    start = tables.table_version(spark, name)
    assert tracked.pending_changes(spark, name, start) is None
    new = rows.where("id <> 3").withColumn("v", F.when(F.col("id") == 5, 0).otherwise(F.col("v")))
    replace = tracked.replace_partitions

    def then_lost(*arguments):
        replace(*arguments)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(tracked, "replace_partitions", then_lost)
    with pytest.raises(RuntimeError, match="driver lost"):
        tracked.overwrite_tracked(new, name, path, layout, ["id"])
    monkeypatch.undo()
    assert spark.read.table(name).count() == 10 and spark.read.table(f"{name}_changes").count() == 3
    assert tracked.pending_changes(spark, name, start) is None
    tracked.overwrite_tracked(new, name, path, layout, ["id"])
    kinds = [row.change_type for row in tracked.pending_changes(spark, name, start).collect()]
    assert sorted(kinds) == ["delete", "update_postimage", "update_preimage"]
    with pytest.raises(ValueError, match="keeps its columns"):
        tracked.overwrite_tracked(new.withColumn("w", F.lit(1)), name, path, layout, ["id"])


def sales_rows(spark):
    return silver.silver_transactions(bronze.bronze_transactions(sample.sales_transactions(spark, "/root/testdata/sf0.01")))


@pytest.fixture
def kept_gold(spark, place):
    """Sales of five weeks as a tracked table, and gold from them."""
    schema, folder = place
    key = F.col("transactionID")
    sales = tables.stored(sales_rows(spark).where("transaction_date BETWEEN '1996-01-01' AND '1996-02-04'"), "test")
    day, layout = F.col("transaction_date"), refresh.LAYOUTS["silver_transactions"]

    def store(df):
        return tracked.overwrite_tracked(df, f"{schema}.silver_transactions", f"{folder}/silver_transactions", layout, ["transactionID"])

    store(sales)
    gold_changes.build(spark, schema, folder)
    second = sales.where(day != "1996-01-09").withColumn(
        "totalPrice", F.when((day == "1996-01-12") & (key % 2 == 0), F.col("totalPrice") + 7).otherwise(F.col("totalPrice"))
    )
    third = second.unionByName(sales.where("transaction_date = '1996-01-20'").withColumns({"transactionID": -key, "customerID": F.lit(1).cast(sales.schema["customerID"].dataType)}))
    return schema, folder, store, second, third


def assert_equals_whole(spark, schema, sales):
    for name, whole in (("gold_daily_sales_summary", gold.daily_sales_summary), ("gold_payment_analysis", gold.payment_analysis)):
        expected, found = whole(sales), spark.read.table(f"{schema}.{name}")
        found = found.select(*expected.columns)
        assert found.count() == expected.count() > 0
        assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0


def test_gold_follows_several_versions(spark, kept_gold):
    schema, folder, store, second, third = kept_gold
    store(second)
    assert set(gold_changes.apply_changes(spark, schema, folder).values()) == {2}
    assert_equals_whole(spark, schema, second)
    assert gold_changes.apply_changes(spark, schema, folder) == {name: 0 for name in gold_changes.TABLES}
    store(third)
    store(second.where("transactionID % 5 <> 1"))  # two versions at once
    gold_changes.apply_changes(spark, schema, folder)
    assert_equals_whole(spark, schema, second.where("transactionID % 5 <> 1"))


@pytest.mark.parametrize("lost_in", ["replace_partitions", "set_properties"])
def test_an_update_that_breaks_off_is_not_added_twice(spark, kept_gold, monkeypatch, lost_in):
    schema, folder, store, second, third = kept_gold
    store(second)

    def lost(*arguments):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(gold_changes, lost_in, lost)
    with pytest.raises(RuntimeError):
        gold_changes.apply_changes(spark, schema, folder)
    monkeypatch.undo()
    store(third)  # the sales move on before gold is mended
    gold_changes.apply_changes(spark, schema, folder)
    assert_equals_whole(spark, schema, third)
    assert tables.folders(spark, f"{folder}/_aside/gold_daily_sales_summary") == []


def test_untouched_days_are_not_read(spark, kept_gold):
    schema, folder, store, second, _ = kept_gold
    stored_gold, sales = spark.read.table(f"{schema}.gold_daily_sales_summary"), store(second)
    changes = tracked.pending_changes(spark, f"{schema}.silver_transactions", tables.table_property(spark, f"{schema}.gold_daily_sales_summary", gold_changes.REFLECTS))
    days = [row[0] for row in changes.select("transaction_date").distinct().collect()]
    assert sorted(map(str, days)) == ["1996-01-09", "1996-01-12"]
    figures = gold_changes.TABLES["gold_daily_sales_summary"]
    update = gold_changes.updated_days(stored_gold, changes, sales, figures, days)
    plan = update._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert any("PartitionFilters: [transaction_date" in line and "1996-01-09" in line for line in scans if "total_revenue" in line)
    assert any("PushedFilters: [In(transaction_date" in line for line in scans if "customerID" in line)
    before = {row[0] for row in stored_gold.select(F.input_file_name()).distinct().collect()}
    gold_changes.apply_changes(spark, schema, folder)
    after = {row[0] for row in spark.read.table(f"{schema}.gold_daily_sales_summary").select(F.input_file_name()).distinct().collect()}
    rewritten = {name.split("transaction_date=")[1].split("/")[0] for name in before ^ after}
    assert rewritten == {"1996-01-09", "1996-01-12"}


def test_a_null_group_is_kept_up_too(spark):
    """Groups with a null franchise are one group, and a group that loses its last sale goes."""
    schema = "transaction_date date, franchiseID long, transactionID long, customerID long, product string, totalPrice long, quantity long"
    day = date(2024, 1, 1)
    before = spark.createDataFrame([(day, None, 1, 1, "a", 5, 1), (day, 7, 2, 1, "a", 5, 1), (day, 8, 3, 2, "b", 4, 2)], schema)
    after = spark.createDataFrame([(day, None, 1, 1, "a", 6, 1), (day, None, 4, 2, "b", 3, 1), (day, 8, 3, 2, "b", 4, 2)], schema)
    changes = tracked.table_changes(before, after, ["transactionID"])
    figures = gold_changes.TABLES["gold_daily_sales_summary"]
    found = gold_changes.updated_days(gold.daily_sales_summary(before), changes, after, figures, [day])
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, gold.daily_sales_summary(after).collect()), key=str)


def test_only_days_with_changes_are_compared_row_by_row(spark, monkeypatch, rows):
    schema = "k long, day date, a int, b int, _ingested_at timestamp"
    one, two, three, none = date(2024, 5, 1), date(2024, 5, 2), date(2024, 5, 3), None
    now = datetime(2024, 6, 1)
    same = [(k, day, k, None, now) for k, day in enumerate([one, one, two, three, none, none])] + [(9, one, 1, 1, now)] * 2
    # a value in the other column, a row that comes twice for another that came twice, and a day that goes
    gone = [(20, two, 5, None), (21, three, 7, 7), (21, three, 7, 7), (22, date(2024, 5, 4), 1, 1)]
    come = [(20, two, None, 5), (21, three, 8, 8), (21, three, 8, 8)]
    before = spark.createDataFrame(same + [(*row, now) for row in gone], schema)
    after = spark.createDataFrame([(*row[:4], datetime(2024, 7, 1)) for row in same] + [(*row, now) for row in come], schema)
    expected = rows(tracked.table_changes(before, after, ["k"]))
    assert len(expected) == 5
    compared, plain = [], tracked.snapshot_changes

    def watched(before, after, keys):
        compared.append({row[0] for side in (before, after) for row in side.select("day").collect()})
        return plain(before, after, keys)

    monkeypatch.setattr(tracked, "snapshot_changes", watched)
    assert rows(tracked.table_changes(before, after, ["k"], "day")) == expected
    assert rows(tracked.table_changes(after, after.withColumn("_ingested_at", F.lit(None)), ["k"], "day")) == []
    assert compared == [{two, three, date(2024, 5, 4)}, set()]
    without_day = spark.createDataFrame([(30, none, 1, 1, now)], schema)
    assert rows(tracked.table_changes(before, before.unionAll(without_day), ["k"], "day"), "k", "change_type") == [(30, "insert")]
    assert compared[-1] == {none}
    monkeypatch.setattr(tracked, "MANY_VALUES", 2)
    assert rows(tracked.table_changes(before, after, ["k"], "day")) == expected
    assert compared[-1] == {one, two, three, none, date(2024, 5, 4)}


def test_the_daily_summary_is_dealt_once(spark, place, monkeypatch):
    schema, folder = place
    sales = silver.silver_transactions(bronze.bronze_transactions(sample.sales_transactions(spark, "/root/testdata/sf0.001")))
    tables.overwrite_table(sales, f"{schema}.silver_transactions", f"{folder}/silver_transactions")
    dealt = {}

    def written(df, table, path, layout):
        dealt[table.split(".")[1]] = tables.arranged(df, layout)._jdf.queryExecution().optimizedPlan().toString()

    monkeypatch.setattr(gold_changes, "overwrite_table", written)
    gold_changes.build(spark, schema, folder)
    daily, payment = dealt["gold_daily_sales_summary"], dealt["gold_payment_analysis"]
    assert daily.count("RepartitionByExpression") == 1 and "RebalancePartitions" not in daily
    assert "RebalancePartitions" in payment


@pytest.mark.parametrize("name", ["gold_from_changes", "payment_from_changes"])
def test_versions_of_the_sales_are_written_as_they_come(spark, monkeypatch, name):
    layouts = []
    monkeypatch.setattr(tracked, "overwrite_tracked", lambda df, table, path, layout, keys: layouts.append(layout))
    monkeypatch.setattr(gold_changes, "build", lambda *place: None)

    def updated(spark, schema, folder, names):
        tables.overwrite_table(spark.range(3), f"{schema}.{names[0]}", f"{folder}/{names[0]}")

    monkeypatch.setattr(gold_changes, "apply_changes", updated)
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() == 3
    assert [layout.as_it_comes for layout in layouts] == [True, True]
    assert all(layout.gather_by == ("transaction_date",) for layout in layouts)
