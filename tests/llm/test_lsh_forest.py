"""Classes and link counts against all pairs, hot groups, recall, and edge cases."""

import random

import numpy as np
import pytest

from goldleaf.llm.lsh_forest import common_counts, enough, hub_pairs, joined_labels, kept_documents, near_classes, shortest_prefix, signature
from goldleaf.llm.words import shingles
from tests.llm.helpers import documents, edge_rows, empty_documents, prose


def brute_force(texts, similarity=0.8):
    """Class (as a set of places) and number of links of each text."""
    sets = [set(shingles(text).tolist()) for text in texts]
    near = [set() for _ in texts]
    for i, one in enumerate(sets):
        for j in range(i):
            union = len(one | sets[j])
            if union and 10 * len(one & sets[j]) >= 10 * similarity * union - 1e-9:
                near[i].add(j)
                near[j].add(i)
    classes, seen = {}, set()
    for start in range(len(texts)):
        if start in seen:
            continue
        group, todo = set(), [start]
        while todo:
            place = todo.pop()
            if place not in group:
                group.add(place)
                todo += near[place]
        seen |= group
        for place in group:
            classes[place] = min(group)
    return classes, [len(one) for one in near]


def varied(base, rng, changes):
    found = base.split()
    for _ in range(changes):
        found[rng.randrange(len(found))] = f"w{rng.randrange(10**6)}"
    return " ".join(found)


def corpus():
    """Singles, exact copies, one large group of near copies, chains, and pairs close to the threshold."""
    rng = random.Random(5)
    texts = [prose(seed, 60 + seed % 40) for seed in range(60)]
    base = prose(1000, 150)
    texts += [varied(base, rng, rng.randrange(7)) for _ in range(120)] + [base] * 30
    for seed in range(40):
        text = prose(2000 + seed, 80)
        texts += [text, varied(text, rng, 1 + seed % 4)]
    chain = prose(3000, 120)
    for _ in range(12):
        texts.append(chain)
        chain = varied(chain, rng, 2)
    texts += ["one two three", "one two  three", "one two four", "", "  "]
    return texts


@pytest.mark.parametrize("block", [16, 256])
def test_agrees_with_all_pairs(spark, block):
    texts = corpus()
    rows = near_classes(documents(spark, list(enumerate(texts))).repartition(6), block=block).collect()
    classes, links = brute_force(texts)
    assert len(rows) == len(texts)
    assert {row["id"]: row["class_id"] for row in rows} == classes
    assert {row["id"]: row["n_links"] for row in rows} == dict(enumerate(links))
    assert {row["id"] for row in rows if row["first"]} == set(classes.values())


def test_whole_table_agrees_with_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = near_classes(docs).collect()
    ids, texts = zip(*sorted(docs.select("doc_id", "text").collect()))
    classes, links = brute_force(texts)
    assert {row["id"]: row["class_id"] for row in rows} == {ids[i]: ids[c] for i, c in classes.items()}
    assert {row["id"]: row["n_links"] for row in rows} == dict(zip(ids, links))


def test_prefixes_shorten_until_the_recall_is_met():
    assert shortest_prefix(24, 8, 0.8, 0.9999) == 5 and shortest_prefix(24, 8, 0.8, 0.5) == 8
    assert shortest_prefix(1, 8, 0.5, 0.99) == 1


def test_signatures_estimate_similarity():
    a, b = shingles(prose(1, 400)), shingles(" ".join(prose(1, 400).split()[:300] + prose(2, 100).split()))
    truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(np.mean(signature(a, 2048) == signature(b, 2048)) - truth) < 0.05


def test_common_counts_and_threshold():
    sets = [np.array([1, 2, 3], np.uint64), np.array([2, 3, 4, 5], np.uint64), np.array([9], np.uint64)]
    assert common_counts(sets).tolist() == [[3, 2, 0], [2, 4, 0], [0, 0, 1]]
    assert enough(4, 5, 0.8) and not enough(79, 100, 0.8)


def test_a_group_gives_as_many_first_pairs_as_it_has_members(spark):
    # 40 members, dealt anew over five trie nodes by each of 24 trees
    rows = [(uid, uid, tree * 10 + (uid * (tree + 7) + tree) % 5) for uid in range(40) for tree in range(24)]
    matched = spark.createDataFrame(rows, "uid long, label long, key long")
    pairs = hub_pairs(matched, 0, one_each=True).collect()
    assert len(pairs) == len({row["b"] for row in pairs}) <= 40
    assert all(row["a"] == row["of"] != row["b"] == row["label"] for row in pairs)
    assert len(pairs) < hub_pairs(matched, 0, one_each=False).count()


def test_a_hub_and_its_members_get_one_label(spark):
    labels = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 3), (5, 5), (9, 9)], "uid long, label long")
    links = spark.createDataFrame([(9, 9, 2, 2), (9, 9, 3, 3)], "a long, of long, b long, label long")
    assert {row["uid"]: row["label"] for row in joined_labels(labels, links).collect()} == {1: 1, 2: 2, 3: 2, 4: 2, 5: 5, 9: 2}


def test_edge_cases(spark):
    docs = documents(spark, edge_rows(), clashing=True)
    kept = kept_documents(docs)
    assert kept.columns == docs.columns
    found = sorted(map(str, (row["doc_id"] for row in kept.collect())))
    # texts without words stay, each alone; of the three equal texts one stays
    assert found == sorted(["1", "2", "3", "None", "None", "4", "6", "7"])
    assert kept.where("doc_id = 1").first()["text"] is None and kept.where("doc_id = 1").first()["_uid"] == 8
    assert near_classes(empty_documents(spark)).count() == 0 and kept_documents(empty_documents(spark)).count() == 0
