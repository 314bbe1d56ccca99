"""Runs against plain code, on words made to repeat in every way, and the cases every operator must take."""

import hashlib
import itertools
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from goldleaf.llm import periodic_runs as op
from goldleaf.llm.catalog import QUERIES
from tests.llm.helpers import SMALL, documents, edge_rows, empty_documents, prose, words


def plain_runs(found, shortest=op.SHORTEST):
    """Every run by trying each period at each place, as (start, length, period)."""
    best = {}
    for period in range(1, len(found) // 2 + 1):
        start = 0
        while start + period < len(found):
            end = start
            while end + period < len(found) and found[end] == found[end + period]:
                end += 1
            if end > start and end + period - start >= max(shortest, 2 * period):
                best.setdefault((start, end + period), period)
            start = max(end, start + 1)
    return sorted(((start, end - start, period) for (start, end), period in best.items()), key=lambda run: (run[0], run[2]))


def examined(texts, shortest):
    return [list(map(tuple, found.tolist())) for found in op.examine([[c.encode() for c in text] for text in texts], shortest)]


@pytest.mark.parametrize("letters, longest", [("ab", 13), ("abc", 8)])
def test_all_short_texts(letters, longest):
    texts = [text for n in range(longest + 1) for text in itertools.product(letters, repeat=n)]
    assert examined(texts, 2) == [plain_runs(text, 2) for text in texts]


def made_of_runs(draw, size):
    text = ""
    while len(text) < size:
        base = "".join(draw.choice("ab") for _ in range(draw.randint(1, 4)))
        text += (base * size)[: draw.randint(1, size)]
    return text[:size]


def test_runs_inside_runs():
    draw, texts = random.Random(7), []
    for _ in range(4000):
        block = made_of_runs(draw, draw.randint(3, 40))
        block += block[::-1] if draw.random() < 0.5 else ""
        block *= 2
        texts.append(made_of_runs(draw, 9) + block + block[: draw.randint(0, len(block) // 2)] + made_of_runs(draw, 9))
    fib = ["a", "ab"]
    while len(fib[-1]) < 700:
        fib.append(fib[-1] + fib[-2])
    texts += [fib[-1], "a" * 500, ("a" * 50 + "b") * 9]
    assert examined(texts, 2) == [plain_runs(text, 2) for text in texts]
    assert examined(texts[:500], 12) == [plain_runs(text, 12) for text in texts[:500]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=60), max_size=6))
def test_texts_together_are_as_texts_alone(texts):
    assert examined(texts, 3) == [plain_runs(text, 3) for text in texts]


def plain_row(doc_id, text):
    found = words(text)
    n, checksum = len(found), zlib.crc32(str(doc_id).encode())
    if checksum % 10 == 0 and n:
        g = checksum // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        found = [found[i] if i < a else found[a + (i - a) % p] for i in range(n)]
    every = plain_runs(found) if n < 1500 else list(map(tuple, op.examine([[w.encode() for w in found]])[0].tolist()))
    dropped = {place for start, length, period in every for place in range(start + period, start + length)}
    kept = " ".join(word for place, word in enumerate(found) if place not in dropped)
    longest = min(every, key=lambda run: (-run[1], run[0], run[2]), default=(None, None, None))
    lines = "".join(f"{start},{length},{period}\n" for start, length, period in every)
    exponent = 1000 * longest[1] // longest[2] if every else None
    digests = [hashlib.sha256(data.encode()).hexdigest() for data in (lines, kept)]
    return (len(every), *longest, exponent, *digests, n)


def test_query_agrees_with_plain_code(spark):
    texts = dict(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    found = {row["doc_id"]: tuple(row)[1:] for row in QUERIES["op11_periodic_runs"](spark, SMALL).collect()}
    assert found.keys() == texts.keys()
    assert sum(row[0] > 0 for row in found.values()) > 10
    for doc_id, text in texts.items():
        assert found[doc_id] == plain_row(doc_id, text), doc_id


def test_edge_cases(spark):
    docs = documents(spark, edge_rows() + [(8, "do re mi fa " * 5), (9, "la " * 11), (10, "la " * 12)], clashing=True)
    rows = docs.select("doc_id", op.periodic_runs(F.col("text")).alias("r")).select("doc_id", "r.*").collect()
    empty = hashlib.sha256(b"").hexdigest()
    for row in rows:
        if row["doc_id"] in (1, 2, 3):
            assert (row["n_words"], row["n_runs"], row["start"], row["runs_sha256"]) == (0, 0, None, empty)
            assert row["collapsed_sha256"] == empty and row["collapsed"] == "" and row["runs"] == []
    by_id = {row["doc_id"]: row for row in rows}
    assert tuple(by_id[8]["runs"][0]) == (0, 20, 4) and by_id[8]["exponent_milli"] == 5000
    assert by_id[9]["n_runs"] == 0 and by_id[10]["n_runs"] == 1 and by_id[10]["collapsed"] == "la"
    assert by_id[6]["n_words"] == 60_000
    out = op.without_repetition(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = {row["doc_id"]: (row["text"], row["found"]) for row in out.collect()}
    assert texts[8] == ("do re mi fa", "g") and texts[1][0] is None and texts[6][0] == prose(2, 60_000)
    assert op.without_repetition(empty_documents(spark)).count() == 0


def test_one_long_run_and_many_texts_in_a_batch(spark):
    long = "one two three four five six seven " * 30_000
    docs = documents(spark, [(1, long)] + [(i, prose(i, 40)) for i in range(2, 60)])
    rows = {row["doc_id"]: row["r"] for row in docs.select("doc_id", op.periodic_runs(F.col("text")).alias("r")).collect()}
    assert tuple(rows[1]["runs"][0]) == (0, 210_000, 7) and rows[1]["n_runs"] == 1
    assert all(rows[i]["n_runs"] == len(plain_runs(prose(i, 40).split())) for i in range(2, 60))
