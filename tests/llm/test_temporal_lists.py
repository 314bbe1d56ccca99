"""Keys of URLs, intervals, the as-of join against plain code (values at scale: the query's SQL), edge cases."""

import datetime as dt
import random

from pyspark.sql import functions as F

from goldleaf.llm.temporal_lists import intervals, judged, url_keys

EVENTS = "list string, verdict string, key string, day timestamp_ntz, action string, seq int"
CAPTURES = "page_id long, url string, at timestamp_ntz, keys string, month int, uid string"


def day(number, hour=0):
    return dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=number)


def captures(spark, rows):
    return spark.createDataFrame([(*row, "k", 1, "u") for row in rows], CAPTURES)


def decisions(df):
    return {row["id"]: (row["decision"], row["matched"], row["n_active"]) for row in df.collect()}


def test_keys(spark):
    row = spark.range(1).select(url_keys(F.lit("HTTPS://me@Blog.A.example.net:80/x//y/?q#f")).alias("k")).first()
    assert row["k"] == [
        "host:blog.a.example.net", "domain:blog.a.example.net", "domain:a.example.net", "domain:example.net",
        "prefix:blog.a.example.net/x", "prefix:blog.a.example.net/x/y",
    ]
    for url in (None, "", "no url", "mailto:x"):
        assert spark.createDataFrame([(url,)], "u string").select(url_keys(F.col("u")).alias("k")).first()["k"] == []


def test_entries_hold_from_addition_to_the_next_event(spark):
    events = spark.createDataFrame([
        ("l", "block", "host:a.b", day(10), "add", 0), ("l", "block", "host:a.b", day(20), "remove", 0),
        ("l", "block", "host:a.b", day(30), "add", 0), ("l", "block", "host:a.b", day(30), "remove", 1),
        ("l", "block", "host:a.b", day(40), "add", 0), ("l", "block", None, day(1), "add", 0),
        ("l", "block", "host:a.b", None, "add", 0), (None, "block", "host:a.b", day(1), "add", 0),
    ], EVENTS)
    found = sorted((row["valid_from"], row["valid_to"]) for row in intervals(events).where("valid_to is not null").collect())
    assert found == [(day(10), day(20))]
    rows = captures(spark, [(n, "http://a.b/", day(n)) for n in (9, 10, 19, 20, 30, 39, 40, 400)])
    blocked = {n for n, found in decisions(judged(rows, events, "page_id", "url", "at")).items() if found[0] == "block"}
    assert blocked == {10, 19, 40, 400}


def test_an_entry_ends_with_any_event_of_its_list_and_key(spark):
    """Blocked, then allowed by the same list: from then on only the later verdict holds."""
    events = spark.createDataFrame([
        ("l", "block", "host:a.b", day(0), "add", 0), ("l", "allow", "host:a.b", day(31), "add", 0),
        ("other", "block", "host:c.d", day(0), "add", 0), ("l", "allow", "host:c.d", day(31), "add", 0),
    ], EVENTS)
    rows = captures(spark, [(1, "http://a.b/", day(10)), (2, "http://a.b/", day(60)), (3, "http://c.d/", day(60))])
    assert decisions(judged(rows, events, "page_id", "url", "at")) == {
        1: ("block", "host:a.b", 1), 2: ("allow", "host:a.b", 1), 3: ("block", "host:c.d", 2)
    }


def test_the_most_specific_key_decides(spark):
    events = spark.createDataFrame([
        ("x", "block", "domain:b.example", day(0), "add", 0), ("y", "allow", "host:a.b.example", day(0), "add", 0),
        ("x", "block", "prefix:a.b.example/p", day(0), "add", 0), ("z", "allow", "prefix:a.b.example/p", day(0), "add", 0),
    ], EVENTS)
    rows = captures(spark, [(1, "http://c.b.example/", day(1)), (2, "http://a.b.example/", day(1)), (3, "http://a.b.example/p/q", day(1)), (4, "http://b.other/", day(1))])
    assert decisions(judged(rows, events, "page_id", "url", "at")) == {
        1: ("block", "domain:b.example", 1), 2: ("allow", "host:a.b.example", 2), 3: ("block", "prefix:a.b.example/p", 4),
        4: ("none", None, 0),
    }


def test_random_histories_against_plain_code(spark):
    rng = random.Random(2)
    events = [("l", "block", f"host:h{rng.randrange(6)}.x", day(rng.randrange(300)), rng.choice(["add", "remove"]), n) for n in range(150)]
    rows = [(n, f"http://h{rng.choice([0, 0, 0, 1, 2, 3, 4, 5])}.x/{n}", day(rng.randrange(300), rng.randrange(24))) for n in range(500)]
    found = decisions(judged(captures(spark, rows), spark.createDataFrame(events, EVENTS), "page_id", "url", "at"))
    for n, url, at in rows:
        key = "host:" + url.split("/")[2]
        past = sorted((e[3], e[5], e[4]) for e in events if e[2] == key and e[3] <= at)
        assert found[n][0] == ("block" if past and past[-1][2] == "add" else "none")


def test_edge_cases(spark):
    events = spark.createDataFrame([("l", "block", "host:a.b", day(0), "add", 0)], EVENTS)
    rows = captures(spark, [(1, None, day(5)), (2, "http://a.b/", None), (3, "http://a.b/", day(5)), (3, "http://a.b/", day(5)), (None, "http://a.b/", day(5))])
    found = judged(rows, events, "page_id", "url", "at").collect()
    assert sorted((str(row["id"]), row["decision"]) for row in found) == [
        ("1", "none"), ("2", "none"), ("3", "block"), ("3", "block"), ("None", "block"),
    ]
    none = spark.createDataFrame([], EVENTS)
    assert {row["decision"] for row in judged(rows, none, "page_id", "url", "at").collect()} == {"none"}
    assert judged(captures(spark, []), events, "page_id", "url", "at").count() == 0
