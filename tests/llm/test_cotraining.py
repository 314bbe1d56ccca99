"""Views, what the rounds add, calibration, accuracy on held-out labels, edge cases."""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from goldleaf.llm import cotraining
from goldleaf.llm.cotraining import PAGE, calibration, cotrain, fit_pair, pair_scores, views
from tests.llm.helpers import documents, edge_rows, empty_documents, empty_labels, prose

FOLDER = "/root/testdata/sf0.1"


def scored(docs, pair):
    return docs.withColumn("p", pair_scores(F.col("text"), F.col("lang"), F.col("source"), pair))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    pair = cotrain(docs, labels.where(part != 0))
    rows = scored(docs.join(labels.where(part == 0), "doc_id"), pair).select("quality", "p.both").collect()
    good = [row["both"] >= 0.5 for row in rows if row["quality"] == 1]
    junk = [row["both"] < 0.5 for row in rows if row["quality"] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(junk) >= 0.9 * len(junk)


def test_views_teach_each_other(spark):
    """Four labelled rows know two words; the page view spreads to texts of other words, and they teach the text view."""
    good = [(i, f"{'alpha' if i < 40 else 'gamma'} {prose(i, 30)}", "en", "s") for i in range(80)]
    bad = [(100 + i, f"{'beta' if i < 40 else 'delta'} {prose(300 + i, 30)} " + "### " * 20, "en", "s") for i in range(80)]
    docs = documents(spark, good + bad)
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(30)], "doc_id long, quality int")
    probe = documents(spark, [(1, "gamma"), (2, "delta")])
    alone, taught = (cotrain(docs, labels, rounds=n, per_round=60, sure=0.6) for n in (0, 2))
    before, after = ([row["p"]["text"] for row in scored(probe, pair).orderBy("doc_id").collect()] for pair in (alone, taught))
    assert after[0] - after[1] > before[0] - before[1] + 0.05


def test_calibration_recovers_a_line():
    rng = np.random.default_rng(1)
    margins = rng.normal(0, 3, 20_000)
    labels = (rng.random(20_000) < 1 / (1 + np.exp(-(0.5 * margins + 1)))).astype(int)
    slope, shift = calibration(margins, labels)
    assert abs(slope - 0.5) < 0.05 and abs(shift - 1) < 0.1
    assert calibration(margins[:3], np.ones(3)) == (1.0, 0.0)


def test_views():
    text, named, page = views("Plain words here.\nMore ###", "en", "src1")
    assert len(named) == 2 and len(page) == PAGE and len(text) > 5
    assert views(None, None, None)[2].tolist() == [0.0] * PAGE
    assert set(views("", None, "a")[1]) != set(views("", "None", "a")[1])


def test_held_rows_are_only_for_calibration():
    rows = [views(f"{'good' if i % 2 else 'bad'} {prose(i, 20)}", "en", "s") for i in range(40)]
    frame = pd.DataFrame({"text_view": [r[0] for r in rows], "named": [r[1] for r in rows], "values": [r[2] for r in rows], "label": np.arange(40) % 2, "role": 0, "held": np.arange(40) % 4 == 0})
    flipped = frame.assign(label=np.where(frame["held"], 1 - frame["label"], frame["label"]))
    assert np.allclose(fit_pair(frame).text.model.weights, fit_pair(flipped).text.model.weights)


def test_edge_cases(spark):
    docs = documents(spark, edge_rows(), clashing=True)
    labels = spark.createDataFrame([(4, 1, 1), (5, 0, 0), (5, 1, 1), (6, 0, 0), (None, 1, 1), (7, None, 1), (99, 0, 1)], "doc_id long, quality int, toxic int")
    found = scored(docs, cotrain(docs, labels)).collect()
    assert len(found) == len(edge_rows()) and all(0 <= row["p"]["both"] <= 1 for row in found)
    same = {row["p"]["both"] for row in scored(docs, cotrain(docs, empty_labels(spark))).collect()}
    assert same == {0.5}
    assert scored(empty_documents(spark), cotrain(docs, labels)).count() == 0
    assert scored(empty_documents(spark), cotrain(empty_documents(spark), labels)).count() == 0


def test_pseudo_labels_and_scores_agree_with_plain_code(spark, monkeypatch):
    """One round: who is taught, found by scoring all unlabelled texts one by one; and the stored views give the same scores."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    kept, keep = {}, cotraining.Workspace.keep

    def spy(work, df, label):
        kept.setdefault(label, []).append(keep(work, df, label))
        return kept[label][-1]

    monkeypatch.setattr(cotraining.Workspace, "keep", spy)
    first = cotrain(docs, labels, rounds=0)
    pair, seen = cotraining.cotrained(docs, labels, rounds=1, per_round=50, sure=0.8)
    known = {row[0] for row in labels.select("doc_id").collect()}
    plain = []
    for doc_id, text, lang, source in docs.select("doc_id", "text", "lang", "source").collect():
        if doc_id not in known:
            sets, named, page = views(text, lang, source)
            p_text, p_page, _ = first.probabilities(cotraining.Rows.of([sets]), cotraining.Rows.of([named], page[None, :]))
            plain.append((doc_id, {"text": p_text[0], "page": p_page[0]}))
    expected, found = [], []
    for view, role in (("page", 1), ("text", 2)):
        for label in (0, 1):
            sure = [(p[view] if label else 1 - p[view], doc_id) for doc_id, p in plain]
            best = sorted(((-p, hashlib.md5(str(doc_id).encode()).hexdigest(), doc_id) for p, doc_id in sure if p >= 0.8))[:50]
            expected.append(sorted((doc_id, label, role) for _, _, doc_id in best))
    for part in kept["taught"]:
        found.append(sorted(tuple(row) for row in part.select("id", "label", "role").collect()))
    assert found == expected and sum(map(len, found)) > 100
    stored = seen.select("id", cotraining.view_scores(pair, *(F.col(name) for name in cotraining.KINDS)).alias("s")).select("id", "s.both")
    direct = scored(docs, pair).select(F.col("doc_id").alias("id"), F.col("p.both").alias("direct"))
    assert stored.join(direct, "id").where("both = direct").count() == docs.count()
