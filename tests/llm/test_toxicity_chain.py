"""The chain's order and out-of-fold inputs, accuracy on held-out labels, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldleaf.llm import linear
from goldleaf.llm.linear import Rows, fit, word_features
from goldleaf.llm.toxicity_chain import best_threshold, fit_chain, scores, train
from tests.llm.helpers import documents, edge_rows, empty_documents, empty_labels, prose

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def halves(spark):
    """Labelled documents and their labels, one half to learn from and one to check."""
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), labels.where(part != 0), labels.where(part == 0)


def test_held_out_accuracy(halves):
    docs, known, hidden = halves
    chain = train(docs, known)
    scored = docs.join(hidden, "doc_id").select("toxic", scores(F.col("text"), chain)["flagged"].alias("flagged")).collect()
    toxic = [row["flagged"] for row in scored if row["toxic"]]
    clean = [row["flagged"] for row in scored if not row["toxic"]]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_training_is_bounded_and_repeatable(halves):
    docs, known, _ = halves
    first, again = train(docs, known, max_rows=100), train(docs.repartition(5), known, max_rows=100)
    sets = [word_features(prose(seed, 50) + " idiot") for seed in range(5)]
    assert np.allclose(first.probabilities(sets), again.probabilities(sets)) and first.threshold == again.threshold


def test_later_categories_see_earlier_ones():
    sets = [word_features(f"{prose(i, 20)} {'rude' if i % 2 else 'kind'}") for i in range(80)]
    first = np.arange(80) % 2
    chain = fit_chain(sets, np.column_stack((first, first)), np.arange(80) % 5, ["one", "two"])
    assert [model.dense_weights.shape[0] for model in chain.models] == [0, 1]
    assert chain.models[1].dense_weights[0] > 0
    found = chain.probabilities([word_features("rude"), word_features("kind")])
    assert (found[0] > 0.5).all() and (found[1] < 0.5).all()


def test_threshold():
    assert 0.3 < best_threshold(np.array([0.9, 0.8, 0.3, 0.1]), np.array([1, 1, 0, 0])) < 0.8
    assert best_threshold(np.array([0.5, 0.5]), np.array([1, 1])) == 0.5


def test_word_beginnings_are_features():
    shared = np.intersect1d(word_features("loweihr"), word_features("loweian"))
    assert len(shared) == 3  # lo-w, lowe, lowei
    assert len(word_features("Word, WORD. word")) == len(word_features("word"))


def test_fit_of_one_kind_and_of_nothing():
    sets = Rows.of([word_features("a b"), word_features("c")])
    assert (fit(sets, np.array([1, 1])).probability(sets) > 0.9).all()
    assert fit(Rows.of([]), np.zeros(0)).probability(sets).tolist() == [0.5, 0.5]
    assert linear.sigmoid(np.array([-1e9, 1e9])).tolist() == pytest.approx([0, 1], abs=1e-9)


def test_edge_cases(spark):
    docs = documents(spark, edge_rows(), clashing=True)
    labels = spark.createDataFrame([(4, 1, 1), (5, 1, 0), (5, 1, 1), (6, 1, 0), (None, 1, 1), (7, 1, None), (99, 0, 1)], "doc_id long, quality int, toxic int")
    chain = train(docs, labels)
    scored = docs.withColumn("s", scores(F.col("text"), chain))
    assert scored.count() == len(edge_rows())
    assert len({row["s"]["toxic"] for row in scored.where("text is null or text = ''").collect()}) == 1
    assert not any(row["f"] for row in docs.select(scores(F.col("text"), train(docs, empty_labels(spark)))["flagged"].alias("f")).collect())
    assert empty_documents(spark).select(scores(F.col("text"), chain)).count() == 0
