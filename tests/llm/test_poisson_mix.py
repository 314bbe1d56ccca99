"""Means, repeatability, large means and edge cases of Poisson replication (values: the query's SQL)."""

from pyspark.sql import functions as F

from goldleaf.llm.poisson_mix import cumulative, replicate, source_rates
from tests.llm.helpers import documents, edge_rows, empty_documents


def corpus(spark, n=2000):
    return documents(spark, [(i, "ten chars.", "en", "big" if i % 4 else "small") for i in range(n)])


def test_shares_follow_the_weights(spark):
    mixed = replicate(corpus(spark), {"big": 1.0, "small": 1.0})
    counts = {row["source"]: row["count"] for row in mixed.groupBy("source").count().collect()}
    assert abs(counts["big"] - 1000) < 150 and abs(counts["small"] - 1000) < 150
    assert sorted(map(str, mixed.collect())) == sorted(map(str, replicate(corpus(spark).repartition(7), {"big": 1.0, "small": 1.0}).collect()))


def test_counts_are_poisson(spark):
    mixed = replicate(corpus(spark), {"small": 3.0})  # mean 2/3 for big, 6/4*... for small
    rates = {row["source"]: row["rate"] for row in source_rates(corpus(spark), {"small": 3.0}).collect()}
    for source, rate in rates.items():
        n = 500 if source == "small" else 1500
        twice = mixed.where(F.col("source") == source).groupBy("doc_id").count().where("count = 2").count()
        import math

        wanted = n * math.exp(-rate) * rate**2 / 2
        assert abs(twice - wanted) < 5 * math.sqrt(wanted + 1)


def test_large_means_are_split(spark):
    mixed = replicate(documents(spark, [(i, "x", "en", "s") for i in range(20)]), {}, rounds=1200.0)
    counts = [row["count"] for row in mixed.groupBy("doc_id").count().collect()]
    assert len(counts) == 20 and abs(sum(counts) / 20 - 1200) < 50 and len(set(counts)) > 5


def test_cumulative_reaches_one(spark):
    row = spark.range(1).select(cumulative(F.lit(3.5)).alias("c"), cumulative(F.lit(0.0)).alias("z")).first()
    assert row["c"] == sorted(row["c"]) and abs(row["c"][-1] - 1) < 1e-12 and row["z"][0] == 1.0


def test_copies_are_numbered_and_shuffled(spark):
    rows = replicate(corpus(spark), {}, rounds=2.0).collect()
    assert {row["copy"] for row in rows} >= {1, 2, 3}
    order = [row["doc_id"] for row in rows]
    assert order != sorted(order)


def test_edge_cases(spark):
    docs = documents(spark, edge_rows(), clashing=True)
    mixed = replicate(docs, {"src1": 2.0}, rounds=3.0)
    assert mixed.columns == [*docs.columns, "_copy", "_shuffle_key"]
    counts = [row["count"] for row in mixed.where("doc_id = 4").groupBy("_copy").count().collect()]
    assert all(count == 2 for count in counts)  # repeated rows have equal counts
    assert replicate(empty_documents(spark), {}).count() == 0
    blank = documents(spark, [(1, None, "en", "a"), (2, "text", "en", "b")])
    assert {row["doc_id"] for row in replicate(blank, {}, rounds=5.0).collect()} == {2}
