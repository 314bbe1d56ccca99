"""A history kept up by batches: late, repeated and broken-off ones, which parts are written, edge cases."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from goldleaf.operators.changes import versions_from_changes
from goldleaf.plans import history as hs
from goldleaf.session import run_folder
from goldleaf.sources.tables import create_schema

COLUMNS = "k string, at int, n int, gone boolean"


def new_history(spark, parts=6):
    name, place = f"h_{uuid.uuid4().hex[:10]}", run_folder(spark, "test")
    create_schema(spark, name, place)
    return hs.History(f"{name}.t", f"{place}/t", ["k"], ["at", "n"], F.floor(F.col("at") / 50), "gone", parts)


def drawn(n, seed=5):
    """One key has a third of the changes; some have no key, some no time, some are ties in time."""
    draw = random.Random(seed)
    keys = [None, *(f"key{i}" for i in range(20))]
    return [
        ("hot" if draw.random() < 0.33 else draw.choice(keys), draw.choice([None, *range(200)]), i, draw.random() < 0.15)
        for i in range(n)
    ]


def whole(spark, changes, history):
    return versions_from_changes(
        spark.createDataFrame(changes, COLUMNS), history.keys, history.sequence, history.bucket, F.col("gone")
    )


def test_batches_in_any_order_equal_one_pass(spark, rows):
    changes, kept = drawn(900), new_history(spark)
    random.Random(1).shuffle(changes)
    for batch in (changes[:500], changes[500:600], changes[400:]):  # the last repeats the second and part of the first
        hs.apply_batch(spark.createDataFrame(batch, COLUMNS), kept)
    assert rows(hs.read_history(spark, kept)) == rows(whole(spark, changes, kept))
    current = whole(spark, changes, kept).where("is_current")
    assert rows(hs.read_current(spark, kept)) == rows(current)
    open_files = hs.read_current(spark, kept).select(F.input_file_name()).distinct().collect()
    assert all("span=open" in row[0] for row in open_files)


def test_a_deletion_that_comes_before_what_it_ends(spark, rows):
    kept = new_history(spark)
    for change in (("a", 9, 1, True), ("a", 3, 2, False), ("a", 5, 3, False)):
        hs.apply_batch(spark.createDataFrame([change], COLUMNS), kept)
    assert rows(hs.read_history(spark, kept), "at", *hs.SPANS) == [(3, 3, 5, False), (5, 5, 9, False)]
    assert hs.read_current(spark, kept).count() == 0


def test_other_parts_are_left_alone(spark, rows):
    changes, kept = drawn(600), new_history(spark, 8)
    hs.apply_batch(spark.createDataFrame(changes, COLUMNS), kept)

    def files():
        found = spark.read.table(kept.table).select(hs.PART, F.input_file_name()).distinct().collect()
        return {part: {row[1] for row in found if row[0] == part} for part in {row[0] for row in found}}

    before, late = files(), [("key3", 17, 10_000, False)]
    written = hs.apply_batch(spark.createDataFrame(late, COLUMNS), kept)
    after = files()
    assert len(written) == 1 and {part for part in before if before[part] != after[part]} == set(written)
    assert rows(hs.read_history(spark, kept)) == rows(whole(spark, changes + late, kept))


@pytest.mark.parametrize("first", [True, False])
def test_a_broken_off_update_is_finished_by_the_next(spark, rows, monkeypatch, first):
    """The rows are laid aside, then the driver is lost: the table shows what it did, and the next batch completes it."""
    changes, kept = drawn(300), new_history(spark)
    done = [] if first else changes[:100]
    if done:
        hs.apply_batch(spark.createDataFrame(done, COLUMNS), kept)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(hs, "replace_partitions", lost)
        patched.setattr(hs, "overwrite_table", lost)
        with pytest.raises(RuntimeError):
            hs.apply_batch(spark.createDataFrame(changes[100:200] if done else changes[:200], COLUMNS), kept)
    if done:
        assert rows(hs.read_history(spark, kept)) == rows(whole(spark, done, kept))
    hs.apply_batch(spark.createDataFrame(changes[200:], COLUMNS), kept)
    assert rows(hs.read_history(spark, kept)) == rows(whole(spark, changes, kept))


def test_empty_batches_and_reserved_names(spark):
    kept = new_history(spark)
    empty = spark.createDataFrame([], COLUMNS)
    assert hs.apply_batch(empty, kept) == [] and not spark.catalog.tableExists(kept.table)
    hs.apply_batch(spark.createDataFrame([("a", 1, 1, None)], COLUMNS), kept)
    assert hs.apply_batch(empty, kept) == [] and hs.read_history(spark, kept).count() == 1
    with pytest.raises(ValueError, match="span"):
        hs.apply_batch(empty.withColumn("Span", F.lit(1)), kept)
