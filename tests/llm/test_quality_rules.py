"""Line rules, base counts against plain code, and the cases every operator must take."""

import re

import pytest

from goldleaf.llm import quality_rules
from goldleaf.llm.catalog import QUERIES
from goldleaf.llm.quality_rules import Rules, judge, kept_documents, line_fault
from tests.llm.helpers import SMALL, documents, edge_rows, empty_documents, prose, words


@pytest.mark.parametrize(
    "line, fault",
    [
        ("A plain sentence that ends.", None),
        ('He said "enough!"', None),
        ("no ending mark on this line", "punctuation"),
        ("Home | News | Sport | Contact", "navigation"),
        ("https://a.example https://b.example go", "navigation"),
        ("All Rights Reserved.", "boilerplate"),
        ("Please enable JavaScript to go on.", "boilerplate"),
        ("BUY!! NOW!! CHEAP!!", "shouting"),
        ("wor### wor&&& wor$$$.", "symbols"),
        ("", None),
    ],
)
def test_line_rules(line, fault):
    assert line_fault(line, words(line), Rules(), False) == fault


def test_short_lines_are_navigation_only_side_by_side():
    body = "\n".join(prose(seed, 40) for seed in range(3))
    assert judge("Title here\n" + body)[8] == 0
    assert judge("Home\nNews\nSport\n" + body)[8] == 3


def test_loss_decides():
    good, bad = prose(1, 70), prose(2, 28).replace(".", "")
    assert judge(good + "\n" + bad)[6] and judge(good + "\n" + bad)[10] == good
    worse = prose(3, 60).replace(".", "")
    assert not judge(good + "\n" + worse)[6]


def plain_counts(text):
    text = text or ""
    found = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    triples = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    again = {i + k for i, triple in enumerate(triples) if triples.count(triple) > 1 for k in range(3)}
    n = len(found)
    failed = n < 50 or 100 * len(again) > 50 * n
    return (
        n, sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), failed
    )


def test_query_counts_agree_with_plain_code(spark):
    texts = dict(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    found = QUERIES["op10_quality_rules"](spark, SMALL).collect()
    assert len(found) == len(texts)
    for row in found:
        if len(words(texts[row["doc_id"]])) < 1500:
            assert tuple(row[1:7]) == plain_counts(texts[row["doc_id"]])
        assert not (row["base_failed"] and row["kept"])


def test_labels_are_met(spark):
    folder = "/root/testdata/sf0.01"
    joined = QUERIES["op10_quality_rules"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = joined.where("not base_failed").select("kept", "quality").collect()
    clean = [row["kept"] for row in rows if row["quality"] == 1]
    junk = [row["kept"] for row in rows if row["quality"] == 0]
    assert all(clean) and sum(junk) <= 0.05 * len(junk)


def test_edge_cases(spark):
    docs = documents(spark, edge_rows(), clashing=True)
    kept = kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(row["doc_id"] for row in kept.collect()) == [4, 4, 5, 6]
    assert kept.first()["rules"] == "rules"
    assert kept_documents(empty_documents(spark)).count() == 0
    assert judge(None)[:6] == (0, 0, 0, 0, 0, True)


def test_cleaned_text_and_length(spark):
    text = prose(1, 70) + "\nCookie policy applies here."
    row = kept_documents(documents(spark, [(1, text)])).first()
    assert row["text"] == prose(1, 70) and row["n_chars"] == len(prose(1, 70))


def test_repeated_windows_of_short_texts():
    assert quality_rules.repeated_window_words(["a"] * 3) == 0
    assert quality_rules.repeated_window_words(["a"] * 4) == 4
    assert quality_rules.repeated_window_words([]) == 0
