"""Token ids, cuts, gapless sequences, few of them, and edge cases."""

import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from goldleaf.llm.query_residual_packing import RANKS, VOCABULARY, packed
from goldleaf.llm.residual_packing import Bins, encode, merged_group, pack, packed_counts, pieces_of
from tests.llm.helpers import documents, edge_rows, empty_documents, prose


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_library(spark, plain):
    texts = [row["text"] for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["a<|endoftext|>b", "日本語 текст", " x y", "  \n\n  tabs\t\tand 123 it's", "", " ", "x\u0085y\x1cz", "é🙂"]
    for text in texts:
        assert encode(text, VOCABULARY, RANKS).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_pieces():
    assert pieces_of(5, 8) == [(0, 5)] and pieces_of(8, 8) == [(0, 8)]
    assert pieces_of(19, 8) == [(0, 3), (3, 8), (11, 8)]


def check(frame, capacity):
    frame = frame.sort_values(["sequence", "offset"])
    before = frame.groupby("sequence")["length"].cumsum() - frame["length"]
    assert (before == frame["offset"]).all()
    assert frame.groupby("sequence")["length"].sum().max() <= capacity


def test_round_trip_and_few_sequences(spark, plain):
    docs = documents(spark, [(i, prose(i, 5 + i * 7 % 900)) for i in range(300)]).repartition(20)
    rows = pack(docs, VOCABULARY, RANKS, fan_in=4).toPandas()
    check(rows, 2048)
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 0], "<u4")
        mine = rows[rows["id"] == doc_id].sort_values("piece")
        assert mine["length"].sum() == len(ids) and mine["start"].tolist() == [0, *mine["length"].cumsum()[:-1]]
        for row in mine.itertuples():
            assert zlib.crc32(ids[row.start : row.start + row.length].tobytes()) == row.crc
    least = -(-rows["length"].sum() // 2048)
    assert rows["sequence"].nunique() <= least * 1.02 + 1


def test_tree_is_as_good_as_one_task(spark):
    docs = documents(spark, [(i, prose(i, 3 + i * 13 % 60)) for i in range(400)])
    spread = pack(docs.repartition(40), VOCABULARY, RANKS, capacity=512, fan_in=3).toPandas()
    single = pack(docs.coalesce(1), VOCABULARY, RANKS, capacity=512).toPandas()
    check(spread, 512)
    assert spread["sequence"].nunique() <= single["sequence"].nunique() * 1.03 + 1


def test_best_fit_takes_the_fullest_bin():
    bins = Bins(10)
    assert [bins.place(n)[0] for n in (7, 5, 3, 4)] == [0, 1, 0, 1]
    assert bins.fills == [10, 9]


@pytest.mark.parametrize("seed", range(5))
def test_counts_are_packed_like_single_pieces(seed):
    """Runs hold every piece once, bins are gapless, and there are as many as best-fit makes piece by piece."""
    draw = random.Random(seed)
    lengths = [draw.choice([draw.randint(1, 64), 40, 25, 9]) for _ in range(3000)]
    counts = dict(zip(*np.unique(lengths, return_counts=True)))
    counts = {int(length): int(n) for length, n in counts.items()}
    bins = Bins(64)
    for length in sorted(lengths, reverse=True):
        bins.place(length)
    runs, n_bins = packed_counts(counts, 64, True)
    assert n_bins == len(bins.fills)
    content = {}
    for length, first, n, place, offset in runs:
        for k in range(n):
            content.setdefault(place + k, []).append((offset, length))
    assert sorted(content) == list(range(n_bins))
    for found in content.values():
        found.sort()
        assert [offset for offset, _ in found] == [sum(length for _, length in found[:k]) for k in range(len(found))]
    for length, n in counts.items():
        numbers = [first + k for run, first, many, _, _ in runs if run == length for k in range(many)]
        assert sorted(numbers) == list(range(n))
    nearly = packed_counts(counts, 64, False)[0]
    filled = {}
    for length, _, n, place, _ in nearly:
        for k in range(n):
            filled[place + k] = filled.get(place + k, 0) + length
    assert all(fill >= 0.98 * 64 for fill in filled.values())


def test_what_goes_up_is_bounded():
    """However many pieces tasks bring, a task of the tree gives a few rows per length."""
    rng = random.Random(3)
    items = pd.DataFrame([(task, length, rng.randint(1, 10**6)) for task in range(8) for length in range(1, 65)], columns=["task", "length", "n"])
    out = merged_group(items, 64, 8, False, 1)
    assert len(out) < 40 * 64
    brought = items.groupby("length")["n"].sum()
    laid, rest = out[out["kind"] == "run"].groupby("length")["n"].sum(), out[out["kind"] == "rest"].set_index("length")["n"]
    assert (laid.reindex(brought.index, fill_value=0) + rest == brought).all()


def test_lengths_that_lie_apart_still_meet(spark):
    """A partition of long texts and seven of texts that fit beside them: near the lower bound, as if dealt at random."""
    long, short = "a " * 1099, "b " * 899
    rows = [(i, long) for i in range(400)] + [(1000 + i, short) for i in range(400)]
    parts = [spark.createDataFrame(rows[:400], "doc_id long, text string").coalesce(1)]
    parts += [spark.createDataFrame(rows[400 + k::7], "doc_id long, text string").coalesce(1) for k in range(7)]
    docs = parts[0]
    for part in parts[1:]:
        docs = docs.union(part)
    found = pack(docs, VOCABULARY, RANKS).toPandas()
    check(found, 2048)
    assert len(found) == 800 and set(found["length"]) <= set(range(890, 1111))
    least = -(-found["length"].sum() // 2048)
    assert found["sequence"].nunique() <= 1.03 * least


def test_edge_cases(spark):
    docs = documents(spark, edge_rows(), clashing=True)
    rows = packed(docs)
    found = rows.collect()
    assert {row["length"] for row in found if row["doc_id"] in (1, 2)} == {1}
    assert len([row for row in found if row["doc_id"] == 4 and row["piece"] == 0]) == 2
    assert any(row["piece"] > 10 for row in found if row["doc_id"] == 6)
    assert packed(empty_documents(spark)).count() == 0
