"""Counts against encoding whole texts one by one, pieces, batches, and the cases every operator must take."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from goldleaf.llm import token_counts as op
from goldleaf.llm.catalog import QUERIES
from tests.llm.helpers import SMALL, documents, edge_rows, empty_documents, prose

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(VOCABULARY)
ODD = (
    "I'll say it's 3.14 <|endoftext|>́ é́ x̸  y z　w <|startoftext|>a "
    "İstanbul ΟΔΟΣ ﬁn 北京 नमस्ते\t\n\x0b\x0c\r 12 345 end don't <|endoftext|> 🎉🎉 "
)


def plain(text):
    return len(PLAIN.encode(text or "", add_special_tokens=False).ids)


def test_query_agrees_with_whole_texts(spark):
    texts = dict(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op13_token_counts"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row["doc_id"]] or ""
        count = plain(text)
        assert tuple(row)[1:] == (len(text.encode()), count, count > 2048)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("piece, batch", [(1, 1), (7, 100), (64, 64), (1 << 16, 1 << 19)])
def test_pieces_have_the_tokens_of_the_whole(name, piece, batch):
    vocabulary = public_tokenizers.path(name)
    whole = Tokenizer.from_file(vocabulary)
    texts = [ODD * 40, prose(3, 400), "", " ", "a" * 500, "a b" * 300, " \n a \t1 " * 50]
    expected = [len(whole.encode(text, add_special_tokens=False).ids) for text in texts]
    assert op.lengths(texts, vocabulary, piece, batch).tolist() == expected


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab1 \n\t'st.<|>́ é京🎉")), max_size=80))
def test_any_text_in_pieces(text):
    assert op.lengths([text], VOCABULARY, 1, 10).tolist() == [plain(text)]


def test_a_full_store_of_parts_changes_nothing(monkeypatch):
    monkeypatch.setattr(op, "KEPT", 50)
    texts = [prose(seed, 200) + ODD for seed in range(30)] + ["long" * 100 + " b"] * 2
    assert op.lengths(texts, VOCABULARY, 100, 1000).tolist() == [plain(text) for text in texts]
    assert len(op._known[VOCABULARY]) <= 400 and max(map(len, op._known[VOCABULARY])) <= op.SHORT


def test_pieces_join_to_the_text():
    text = ODD * 500
    parts = op.pieces(text, 1000)
    assert "".join(parts) == text and len(parts) > 20
    assert op.pieces("京" * 5000, 1000) == ["京" * 5000]


def test_batches_hold_about_the_same_bytes():
    texts = [prose(seed, 20) for seed in range(300)] + [prose(1, 20_000)] + [prose(seed, 20) for seed in range(300)]
    sizes = [sum(map(len, parts)) for _, parts in op.batches(texts, 1 << 10, 1 << 13)]
    assert len(sizes) > 15 and max(sizes) < (1 << 13) + 2 * (1 << 10) and min(sizes[:-1]) >= 1 << 13


def test_edge_cases(spark):
    docs = documents(spark, edge_rows() + [(8, ODD * 3000), (9, "京" * 100_000)], clashing=True).withColumn("n_tokens", F.lit(5))
    out = op.with_token_counts(docs, VOCABULARY)
    assert out.columns == [*docs.columns, "_n_bytes", "_n_tokens"] and out.count() == docs.count()
    for row in out.collect():
        text = row["text"] or ""
        assert (row["_n_bytes"], row["_n_tokens"], row["n_tokens"]) == (len(text.encode()), plain(text), 5)
    assert op.with_token_counts(empty_documents(spark), VOCABULARY).count() == 0
