"""Base scores against plain code, a proper distribution, clustering that finds classes, edge cases."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldleaf.llm import brown_lm
from goldleaf.llm.brown_lm import DISCOUNT, HALF, Vocabulary, bigram_likelihood, exchange, part_classes, scores, words_and_buckets
from goldleaf.llm.catalog import QUERIES
from tests.llm.helpers import SMALL, documents, edge_rows, empty_documents, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


def test_base_and_counts_agree_with_plain_code(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    tokens = {row["doc_id"]: [*words((row["text"] or "").translate(LOWER)), None] for row in docs}
    counts = collections.Counter(t for i, found in tokens.items() if not held(i) for t in found)
    n, v = sum(counts.values()), len(counts)
    rows = QUERIES["op6_brown_lm"](spark, SMALL).collect()
    assert len(rows) == len(tokens)
    for row in rows:
        mine = tokens[row["doc_id"]]
        assert (row["held_out"], row["n_tokens"], row["train_tokens"]) == (held(row["doc_id"]), len(mine), n)
        assert row["n_known"] == sum(counts[t] > 0 for t in mine)
        assert row["base_score"] == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in mine), rel=1e-9)
        assert row["perplexity"] == pytest.approx(10 ** (-row["score"] / len(mine)))
    hidden = [row for row in rows if row["held_out"]]
    assert sum(row["score"] for row in hidden) > sum(row["base_score"] for row in hidden)


def template_texts(n, seed=3):
    """Names follow titles, verbs follow names, places follow verbs: four word classes."""
    rng = random.Random(seed)
    kinds = [[f"{kind}{i}" for i in range(8)] for kind in ("title", "name", "verb", "place")]
    return [" ".join(rng.choice(kind) for _ in range(3) for kind in kinds) for _ in range(n)]


def test_class_order_matters(spark):
    texts = template_texts(300)
    rng = random.Random(1)
    shuffled = []
    for text in template_texts(40, 9):
        found = text.split()
        rng.shuffle(found)
        shuffled.append(" ".join(found))
    rows = [(i, text) for i, text in enumerate(texts)]
    rows += [(1000 + i, text) for i, text in enumerate(template_texts(40, 9))] + [(2000 + i, text) for i, text in enumerate(shuffled)]
    found = scores(documents(spark, rows), F.col("doc_id") < 1000, n_classes=8, buckets=4).collect()
    right = np.mean([row["score"] for row in found if 1000 <= row["id"] < 2000])
    wrong = np.mean([row["score"] for row in found if row["id"] >= 2000])
    base = np.mean([row["base_score"] for row in found if 1000 <= row["id"] < 2000])
    assert right > wrong + 3 and right > base + 3


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(0)
    n, true = 40, np.arange(40) % 4
    bigrams = rng.poisson(np.where((true[:, None] + 1) % 4 == true[None, :], 8, 0.2))
    bigrams[0, :] = bigrams[:, 0] = 0
    classes = rng.integers(0, 4, n)
    classes[0] = 4

    def state(classes):
        member = np.eye(5, dtype=int)[classes]
        return bigrams @ member, bigrams.T @ member, np.diag(bigrams), member.T @ bigrams @ member

    values = []
    for turn in range(8):
        after, before, own, matrix = state(classes)
        values.append(bigram_likelihood(matrix))
        classes = exchange(classes, matrix, after, before, own, np.arange(1, n)[turn % 2 :: 2])
    assert values[-1] > values[0] and values[-1] >= bigram_likelihood(state(np.where(np.arange(n) == 0, 4, true))[3]) * 1.02


def bucket_of(word, buckets):
    return int(words_and_buckets(word, buckets)[1][0])


def test_scores_agree_with_plain_code_and_sum_to_one(spark, monkeypatch):
    """All texts scored token by token from the classes that the operator gave, and the mass of all words after each class."""
    n_classes, buckets = 6, 16
    rows = [(i, text + f" solo{i} Pair{i // 2} odd{i % 40}") for i, text in enumerate(template_texts(240, 5))]
    rows += [(1000 + i, f"title1 unseen{i} name{i % 8} solo{i} verb2 brandnew") for i in range(30)] + [(2000, None), (2001, "")]
    kept, keep = {}, brown_lm.Workspace.keep

    def spy(work, df, label):
        kept[label] = keep(work, df, label)
        return kept[label]

    given = {}
    score = brown_lm.score_column
    monkeypatch.setattr(brown_lm.Workspace, "keep", spy)
    monkeypatch.setattr(brown_lm, "score_column", lambda model, matrix: given.update(model=model) or score(model, matrix))
    docs = documents(spark, rows).repartition(5)
    held_out = (F.col("doc_id") >= 1000) & (F.col("doc_id") < 2000)
    found = {row["id"]: row for row in scores(docs, ~held_out, n_classes=n_classes, buckets=buckets, frequent=20).collect()}
    model = given["model"]

    tokens = {doc_id: [*words((text or "").translate(LOWER)), None] for doc_id, text in rows}
    classes = {row["id"]: list(row["classes"]) for row in kept["classes"].collect()}
    train = [doc_id for doc_id in tokens if not 1000 <= doc_id < 2000]
    counts = collections.Counter(t for doc_id in train for t in tokens[doc_id])
    class_of = {}
    for doc_id, found_tokens in tokens.items():
        assert len(classes[doc_id]) == len(found_tokens)
        for token, own in zip(found_tokens, classes[doc_id]):
            assert class_of.setdefault(token, own) == own  # a word has one class, wherever it stands
    bucket_class = {b: int(model.classes[model.first_bucket + b]) for b in range(buckets)}
    rare = [t for t, c in counts.items() if t is not None and c < 3]
    for token, own in class_of.items():
        if token is not None and counts[token] < 3:
            assert own == bucket_class[bucket_of(token, buckets)]
    once, twice = (sum(counts[t] == n for t in rare) for n in (1, 2))
    discount = min(max((once + 1) / (once + 2 * twice + 2), 0.05), 0.95)
    in_bucket = collections.defaultdict(list)
    for t in rare:
        in_bucket[bucket_of(t, buckets)].append(t)
    steps = collections.Counter()
    for doc_id in train:
        line = classes[doc_id]
        steps.update(zip([n_classes, *line[:-1]], line))
    ends = counts[None]
    mass = collections.defaultdict(float)  # of each class
    for t, c in counts.items():
        if t is not None and c >= 3:
            mass[class_of[t]] += c
    for b in range(buckets):
        mass[bucket_class[b]] += HALF + sum(counts[t] for t in in_bucket[b])
    mass[n_classes] += ends + HALF

    def transition(a, b):
        every = range(n_classes + 1)
        total = sum(steps.values())
        single = (sum(steps[k, b] for k in every) + HALF) / (total + HALF * (n_classes + 1))
        row = sum(steps[a, k] for k in every)
        if not row:
            return single
        free = row - sum(max(steps[a, k] - DISCOUNT, 0) for k in every)
        return (max(steps[a, b] - DISCOUNT, 0) + free * single) / row

    def emission(t, b=None):
        """Of a word; with a bucket instead, of all words never seen that share it."""
        if t is None and b is None:
            return n_classes, (ends + HALF) / mass[n_classes]
        if b is None and counts[t] >= 3:
            return class_of[t], counts[t] / mass[class_of[t]]
        bucket = bucket_of(t, buckets) if b is None else b
        tokens_in = sum(counts[w] for w in in_bucket[bucket])
        share = (tokens_in + HALF) / mass[bucket_class[bucket]]
        if tokens_in == 0:
            return bucket_class[bucket], share
        inside = counts[t] - discount if b is None and counts[t] else discount * len(in_bucket[bucket])
        return bucket_class[bucket], share * inside / tokens_in

    for doc_id, line in tokens.items():
        total, before = 0.0, n_classes
        for t in line:
            own, p = emission(t)
            total += math.log10(transition(before, own) * p)
            before = own
        assert found[doc_id]["score"] == pytest.approx(total, rel=1e-9), doc_id
    events = [emission(t) for t in counts] + [emission(None, b) for b in range(buckets)]
    for before in range(n_classes + 1):
        assert sum(transition(before, own) * p for own, p in events) == pytest.approx(1.0, abs=1e-9)


def test_words_buckets_and_types():
    hashes, buckets = words_and_buckets("The the ÉCOLE école walking talking", 16)
    assert hashes[0] == hashes[1] and hashes[2] != hashes[3] and buckets[4] == buckets[5]
    vocabulary = Vocabulary(np.sort(hashes[:1]), np.array([5]), 16)
    assert vocabulary.types(hashes, buckets)[:2].tolist() == [1, 1] and vocabulary.types(hashes, buckets)[4] == 2 + buckets[4]
    assert Vocabulary(np.zeros(0, np.int64), np.zeros(0, np.int64), 16).types(hashes, buckets).min() >= 1


def test_edge_cases(spark):
    docs = documents(spark, edge_rows(), clashing=True)
    rows = scores(docs, F.lit(True)).collect()
    assert len(rows) == len(edge_rows())
    blank = [row for row in rows if row["n_tokens"] == 1]
    assert len(blank) == 4 and len({row["score"] for row in blank}) == 1 and all(math.isfinite(row["score"]) for row in rows)
    none = scores(docs, F.lit(False)).collect()
    assert all(row["n_known"] == 0 and row["train_tokens"] == 0 and math.isfinite(row["score"]) for row in none)
    assert scores(empty_documents(spark), F.lit(True)).count() == 0


def test_words_that_are_not_exchanged_have_classes_too(spark):
    """With twelve exchanged words of 32, most words choose their class by their contexts, and order still matters."""
    texts = template_texts(300)
    rng = random.Random(1)
    shuffled = []
    for text in template_texts(40, 9):
        found = text.split()
        rng.shuffle(found)
        shuffled.append(" ".join(found))
    rows = [(i, text) for i, text in enumerate(texts)]
    rows += [(1000 + i, text) for i, text in enumerate(template_texts(40, 9))] + [(2000 + i, text) for i, text in enumerate(shuffled)]
    docs = documents(spark, rows).repartition(3)
    found = scores(docs, F.col("doc_id") < 1000, n_classes=8, buckets=4, frequent=12).collect()
    right = np.mean([row["score"] for row in found if 1000 <= row["id"] < 2000])
    wrong = np.mean([row["score"] for row in found if row["id"] >= 2000])
    assert right > wrong + 3


def test_every_word_seen_often_enough_has_a_class(monkeypatch):
    """Words of a part, taken a few at a time: counts, classes by contexts, none for the rare."""
    monkeypatch.setattr(brown_lm, "WORDS_AT_ONCE", 3)
    rng, n = np.random.default_rng(2), 5
    matrix = np.full((n, n), 2.0)
    matrix[0, 1] = matrix[1, 2] = matrix[2, 3] = 400
    pairs = []
    for word in range(10):  # word k stands where class 1 + k % 3 would
        often = 2 if word == 4 else 30
        own = 1 + word % 3
        pairs += [(word, (own - 1) * n + (own + 1) % n) for _ in range(often)]
    rng.shuffle(pairs)
    words_, around = np.array(pairs).T
    c, best = part_classes(words_, around, 11, matrix, 3)
    assert c.tolist() == [30] * 4 + [2] + [30] * 5 + [0]
    assert best.tolist() == [1, 2, 3, 1, -1, 3, 1, 2, 3, 1, -1]


def test_places_that_need_more_bytes(spark):
    """A text of more different rare words than two bytes can number."""
    many = " ".join(f"w{i}" for i in range(70_000))
    found = scores(documents(spark, [(1, many), (2, "w1 w2 w69999 other")]), F.col("doc_id") == 1, n_classes=3, frequent=0)
    rows = {row["id"]: row for row in found.collect()}
    assert rows[1]["n_tokens"] == rows[1]["n_known"] == 70_001 and rows[2]["n_known"] == 4
