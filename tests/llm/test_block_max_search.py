"""Search against scoring every document, the index's packing, pruning, and the cases every operator must take."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from goldleaf.llm import block_max_search as op
from goldleaf.llm.catalog import QUERIES
from goldleaf.llm.common import Workspace
from tests.llm.helpers import SMALL, documents, edge_rows, empty_documents

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SMALL_LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(SMALL_LETTERS))


def plain_search(docs, items, k=10):
    counted = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    lengths = [sum(found.values()) for _, found in counted]
    n_docs, total = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(term for _, found in counted for term in found)
    out = []
    for item, text in items:
        scored = []
        for (doc_id, found), n in zip(counted, lengths):
            score = 0
            for term in set(plain_terms(text)):
                tf = found.get(term, 0)
                if tf:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += weight * (1_000_000_000 * tf // (1000 * tf + 8 * (10 + 90 * n * n_docs // total)))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(scored, key=lambda row: (row[0], row[1], row[2] or 0))[:k], 1):
            out.append((item, rank, doc_id, -score))
    return sorted(out, key=str)


def found_by(spark, docs, items, k=10):
    index = Workspace(spark, "test-index").keep(op.build_index(docs), "index")
    queries = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(row) for row in op.search(index, queries, k).collect()), key=str)


def test_query_agrees_with_plain_code(spark):
    docs = [tuple(row) for row in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(row) for row in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    found = sorted((tuple(row) for row in QUERIES["op12_block_max_search"](spark, SMALL).collect()), key=str)
    assert found == plain_search(docs, items) and len(found) == 10 * len(items)


def made_texts(seed, n):
    draw = random.Random(seed)
    vocabulary = [f"w{place}" for place in range(400)]
    weights = [1 / (place + 1) for place in range(400)]
    return [(doc, " ".join(draw.choices(vocabulary, weights, k=draw.choice([3, 20, 60, 300])))) for doc in range(n)]


@pytest.mark.parametrize("shard_docs", [300, 5000])
def test_many_documents_in_shards_and_blocks(spark, monkeypatch, shard_docs):
    monkeypatch.setattr(op, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(op, "QUERIES", 7)
    docs = made_texts(5, 3000)
    items = [(place, text) for place, (_, text) in enumerate(made_texts(6, 40))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert found_by(spark, frame, items) == plain_search(docs, items)


def shard_lists(seed, n_docs, n_terms):
    """Lists of one shard, as the search gets them, and the plain scores of all documents."""
    shard = op.Shard()
    texts = made_texts(seed, n_docs)
    shard.add([doc for doc, _ in texts], [op.terms(text) for _, text in texts])
    head, *body = shard.rows(0)
    body = pa.Table.from_batches(body).combine_chunks().to_batches()[0]
    lengths = np.asarray(head.column("last")[0].values)
    norm = op.Norm(n_docs, int(lengths.sum()), lengths)
    lists, sums = [], np.zeros(n_docs, np.int64)
    for row in random.Random(seed).sample(range(len(body)), n_terms):
        weight = max(1, int(1000 * math.log((2 * n_docs + 2) / (2 * body.column("df")[row].as_py() + 1))))
        arrays = [np.asarray(body.column(name)[row].values) for name in ("last", "most", "shortest", "ends")]
        lists.append(op.Postings(weight, body.column("df")[row].as_py(), *arrays, body.column("postings")[row].as_py(), norm))
        full = op.Postings(weight, body.column("df")[row].as_py(), *arrays, body.column("postings")[row].as_py(), norm)
        docs, points = full.window(0, n_docs)
        assert (full.most(docs) >= points).all()
        sums[docs] += points
    return lists, sums


@pytest.mark.parametrize("seed", range(6))
def test_pruning_loses_nothing_and_saves_blocks(seed):
    lists, sums = shard_lists(seed, 8000, 30)
    docs, points = op.best(lists, 8000, 10)
    order = np.lexsort((np.arange(8000), -sums))[:10]
    assert docs.tolist() == order.tolist() and points.tolist() == sums[order].tolist()
    opened, blocks = sum(int(found.known.sum()) for found in lists), sum(len(found.known) for found in lists)
    assert opened < blocks


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=50))
def test_packing_is_reversible(values):
    packed, ends = op.pack(np.array(values, np.int64))
    assert op.unpack(packed).tolist() == values and ends[-1] == len(packed)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_terms_are_those_of_the_pattern(text):
    assert [term.decode() for term in op.terms(text)] == plain_terms(text)


def test_edge_cases(spark):
    rows = edge_rows() + [(8, "Word wORD É é İ x́ naïve 北京 v2.0"), (9, "same text here"), (3, "same text here"), (12, "WORD_word-word")]
    items = [(1, "word"), (2, None), (3, ""), (4, "same text"), (4, "same text"), (None, "É 北京 2 nowhere"), (5, "same same")]
    docs = documents(spark, rows, clashing=True)
    found = found_by(spark, docs, items)
    assert found == plain_search([row[:2] for row in rows], items)
    assert [row for row in found if row[0] == 4 and row[1] <= 2 and row[2] in (3, 9)] and not [row for row in found if row[0] in (2, 3)]
    assert found_by(spark, empty_documents(spark), items) == []
    assert found_by(spark, docs, []) == []
