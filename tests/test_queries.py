"""Every registered query against its SQL on the small tables, and a look at every plan."""

import pytest

import __spark_entry__ as entry_points
from goldleaf.plans import bronze, silver
from goldleaf.queries import ORACLES, QUERIES
from goldleaf.sources import sample_tables as sample
from goldleaf.sources import tables
from tools.check_oracle import compare, sql_connection

SMALL = "/root/testdata/sf0.001"
# Queries without a SQL counterpart.
ROWS_ONLY: set[str] = set()
# Plans that start by writing a table or running a stream.
EAGER = {
    "train_fare_model", "materialize_roundtrip", "clustered_write_scan", "overwrite_new_schema", "run_row_counts", "refresh_change_feed",
    "json_source_roundtrip", "stream_ingest_silver", "monitoring_row_counts", "publish_after_failed_write", "gold_from_changes",
    "payment_from_changes", "monitor_drift_of_touched_days", "monitor_profile_window", "history_from_batches", "stream_quarantine",
    "stream_rule_counts",
}


@pytest.fixture(scope="module")
def connection():
    return sql_connection(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, connection, name):
    assert compare(spark, connection, SMALL, name) == []


def test_registry():
    assert entry_points.queries().keys() >= QUERIES.keys()
    assert entry_points.oracle_sql().keys() >= ORACLES.keys()
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0 and "total_revenue" in df.columns


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_plan_has_no_cross_join_and_no_global_window(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if "Window" in plan:
        assert "Exchange SinglePartition" not in plan
    if name != "score_with_predictor":
        assert "EvalPython" not in plan and "InPandas" not in plan


def test_only_needed_columns_are_read(spark):
    plan = QUERIES["agg_sum_count_avg"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    lineitem = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "l_extendedprice" in lineitem
    assert "l_shipdate" not in lineitem and "l_discount" not in lineitem


def test_quality_rules_reach_the_scan(spark):
    stored = tables.stored(bronze.bronze_transactions(sample.sales_transactions(spark, SMALL)), "test")
    plan = silver.silver_transactions(stored)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") : plan.index("ReadSchema")]
    assert "IsNotNull(transactionID)" in pushed
    # long lists are cut short in the text; the whole condition stands in the filter above the scan
    for rule in ("isnotnull(transactionID", "isnotnull(customerID", "isnotnull(franchiseID", "quantity", "totalPrice"):
        assert rule in plan[: plan.index("FileScan")]
