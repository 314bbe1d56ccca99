import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from goldleaf.operators.changes import snapshot_changes, versions_from_changes


def test_snapshot_changes(spark, rows):
    schema = "k int, a string, b double"
    before = spark.createDataFrame([(1, "x", 1.0), (2, "y", None), (3, "z", 3.0), (None, "n", 0.0)], schema)
    after = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0), (4, "w", 4.0), (None, "m", 0.0)], schema)
    found = snapshot_changes(before, after, ["k"])
    assert rows(found, "k", "a", "b", "change_type", "copies") == [
        (2, "y", 2.0, "update_postimage", 1),
        (2, "y", None, "update_preimage", 1),
        (3, "z", 3.0, "delete", 1),
        (4, "w", 4.0, "insert", 1),
        (None, "m", 0.0, "update_postimage", 1),
        (None, "n", 0.0, "update_preimage", 1),
    ]


def test_unchanged_snapshot_has_no_changes(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "b")], "k int, a string")
    assert snapshot_changes(df, df, ["k"]).count() == 0


def test_repeated_rows_are_counted_not_multiplied(spark):
    draw = random.Random(5)
    hot = [(0, draw.randrange(3)) for _ in range(600)]
    before = hot + [(draw.randrange(1, 20), draw.randrange(3)) for _ in range(900)]
    after = [row for row in before if draw.random() < 0.7] + [(draw.randrange(20), 9) for _ in range(50)]
    found = snapshot_changes(
        spark.createDataFrame(before, "k int, a int"), spark.createDataFrame(after, "k int, a int"), ["k"]
    ).collect()
    gained, lost = Counter(after) - Counter(before), Counter(before) - Counter(after)
    signs = {"insert": 1, "update_postimage": 1, "delete": -1, "update_preimage": -1}
    assert {(r.k, r.a): signs[r.change_type] * r.copies for r in found} == {
        **gained, **{row: -n for row, n in lost.items()}
    }


def test_versions_match_a_plain_walk(spark):
    draw = random.Random(7)
    changes = [(0 if draw.random() < 0.4 else draw.randrange(1, 30), step, draw.random() < 0.1) for step in range(800)]
    draw.shuffle(changes)
    df = spark.createDataFrame(changes, "k int, at int, gone boolean")
    found = versions_from_changes(df, ["k"], ["at"], bucket=F.floor(F.col("at") / 100), deleted=F.col("gone"))
    by_key = defaultdict(list)
    for key, at, gone in sorted(changes, key=lambda change: change[1]):
        by_key[key].append((at, gone))
    expected = {
        (key, at): later
        for key, steps in by_key.items()
        for (at, gone), later in zip(steps, [step for step, _ in steps[1:]] + [None])
        if not gone
    }
    got = {(r.k, r.effective_from): r.effective_to for r in found.collect()}
    assert got == expected
    assert all(r.is_current == (r.effective_to is None) for r in found.collect())


def test_large_buckets_and_missing_keys(spark):
    """One key holds most changes of one bucket, with ties; some changes have no key."""
    draw = random.Random(4)
    rows = [("hot" if draw.random() < 0.8 else draw.choice(["a", "b", None]), draw.randrange(200), k) for k in range(1500)]
    df = spark.createDataFrame(rows, "key string, at int, n int").repartition(5)
    found = versions_from_changes(df, ["key"], ["at", "n"], bucket=F.lit(1), rows_per_slice=50).collect()
    assert len(found) == len(rows)
    following = {}
    for key in {row[0] for row in rows}:
        own = sorted((at, n) for k, at, n in rows if k == key)
        following.update({n: (later[0] if later else None) for (_, n), later in zip(own, [*own[1:], None])})
    assert {r.n: r.effective_to for r in found} == following
    assert sum(r.is_current for r in found) == 4
