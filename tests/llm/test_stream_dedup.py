"""Groups of equal texts, checked hits under a colliding digest, state that outlives a run, edge cases."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from goldleaf.llm.common import Workspace
from goldleaf.llm.stream_dedup import advance_state, classes, fingerprints, kept_documents, located, read_state, sha256
from tests.llm.helpers import documents, edge_rows, empty_documents, words


def expected(rows):
    """doc_id order decides; equal after white space is squeezed."""
    groups = defaultdict(list)
    for row in rows:
        text = row[1] or ""
        key = (text[:1].isspace(), tuple(words(text)), bool(words(text)) and text[-1:].isspace())
        groups[key].append(row[0])
    return {key: ids for key, ids in groups.items()}


def sizes(df):
    return sorted((str(row["id"]), str(row["keep_id"]), row["group_size"]) for row in df.collect())


ROWS = [(9, "b  a"), (3, "b a"), (5, "b\ta"), (4, "a b"), (8, "a b"), (1, "ab"), (2, "ba"), (7, "x"), (6, "y")]


def test_groups_and_first(spark):
    found = classes(documents(spark, ROWS))
    assert sizes(found) == sorted(
        (str(i), str(min(ids)), len(ids)) for ids in expected(ROWS).values() for i in ids
    )
    assert {row["id"] for row in found.where("kept").collect()} == {3, 4, 1, 2, 7, 6}


def test_bytes_settle_colliding_digests(spark):
    def weak(text):
        return F.unhex(F.lpad(F.hex(F.length(text)), 8, "0"))

    plain, found = classes(documents(spark, ROWS)), classes(documents(spark, ROWS), digest=weak)
    assert sizes(found) == sizes(plain)
    assert sorted(map(str, found.select("id", "kept", "sha").collect())) == sorted(map(str, plain.select("id", "kept", "sha").collect()))


def test_state_outlives_a_run(spark):
    work = Workspace(spark, "test-state")
    folder = work.path("state")
    prints = work.keep(fingerprints(located(documents(spark, ROWS), work), "doc_id", "text", sha256), "prints")
    advance_state(prints, folder, 1 << 30)
    more = fingerprints(located(documents(spark, [(0, "b a"), (50, "new")]), work), "doc_id", "text", sha256)
    more.write.mode("append").parquet(prints._stored_at)
    advance_state(prints, folder, 1 << 30)
    state = read_state(prints, folder).select("first.id", "n").collect()
    assert sorted(map(tuple, state)) == [(0, 4), (1, 1), (2, 1), (4, 2), (6, 1), (7, 1), (50, 1)]


def by_length(text):
    """A digest that texts of one length share."""
    return F.unhex(F.lpad(F.hex(F.length(text)), 8, "0"))


def so_far(batches, upto):
    """Of the rows of a batch, what all batches up to one say of them."""
    groups = expected([row for batch in batches[: upto + 1] for row in batch])
    return {i: (min(ids), len(ids), i == min(ids)) for ids in groups.values() for i in ids}


@pytest.mark.parametrize("digest", [sha256, by_length])
def test_batches_through_the_public_function(spark, digest):
    """Later batches meet the texts of earlier ones; under a forged digest the texts decide, whichever batch they came in."""
    batches = [
        ROWS,
        [(0, "b a"), (50, "new"), (51, "zz top"), (52, None), (53, "a b")],
        [(54, "zz  top"), (-1, "xx"), (55, ""), (56, "yy"), (57, "b a")],
        [(58, "xx"), (59, "ab")],
    ]
    folder = Workspace(spark, "test-state").path("state")
    for number, rows in enumerate(batches):
        found = classes(documents(spark, rows), digest=digest, state_folder=folder, batch=f"day-{number}")
        want = so_far(batches, number)
        got = {row["id"]: (row["keep_id"], row["group_size"], row["kept"]) for row in found.collect()}
        assert got == {row[0]: want[row[0]] for row in rows}
    # given again: not counted twice, and told what all batches say by now
    again = classes(documents(spark, batches[1]), digest=digest, state_folder=folder, batch="day-1")
    want = so_far(batches, len(batches))
    assert {r["id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in again.collect()} == {r[0]: want[r[0]] for r in batches[1]}
    assert classes(empty_documents(spark), digest=digest, state_folder=folder).count() == 0


def test_edge_cases(spark):
    docs = documents(spark, edge_rows(), clashing=True)
    kept = kept_documents(docs)
    assert kept.columns == docs.columns
    # null and empty are one group, blank is one space; of the repeated row one stays; without a name comes last
    assert sorted(str(row["doc_id"]) for row in kept.collect()) == sorted(["1", "3", "None", "4", "6", "7"])
    assert classes(empty_documents(spark)).count() == 0 and kept_documents(empty_documents(spark)).count() == 0
