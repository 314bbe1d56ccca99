"""Temporal URL lists: every capture against the list entries that were active when it was fetched.

List changes are dated events: on a day a key is added to a list or removed from it. Keys are

* ``host:h``, this host alone;
* ``domain:d``, this domain and all hosts below it (two labels at least);
* ``prefix:h/a/b``, pages of this host below this path.

Events become validity intervals: from an addition until the next event of the same list and key. Of
several events on one day the one with the highest ``seq`` counts (then a removal), so a key has at most one
interval per day, however many events it gets.

The as-of join is an equi-join on key and month: intervals are repeated for the months they touch, and inside
the month the fetch time must lie in the interval. A host or domain that a third of all captures share is
joined by months, and adaptive execution splits what is still too large, as the list side is small there.
Matches are reduced on the map side: the most specific key wins (prefix, longest first, then host, then the
longest domain), and ``block`` beats ``allow`` on the same key.

A capture without URL, without host or without fetch time matches nothing and is kept with decision ``none``.
Events without list, key or day are ignored. Repeated captures are judged each for itself; an empty list gives
``none`` everywhere, empty captures an empty result. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.llm.common import Workspace

def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_keys(url: Column) -> Column:
    """All keys that a URL can match: its host, its domains, its path prefixes."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    domains = F.transform(
        F.filter(F.sequence(F.lit(1), n), lambda i: i < n),
        lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, n), ".")),
    )
    steps = F.filter(F.split(path_of(url), "/"), lambda part: part != "")
    prefixes = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(steps)), lambda i: i > 0),
        lambda i: F.concat(F.lit("prefix:"), host, F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i), "/")),
    )
    keys = F.concat(F.array(F.concat(F.lit("host:"), host)), domains, prefixes)
    return F.when(url.isNotNull() & (host != ""), F.array_distinct(keys)).otherwise(F.array().cast("array<string>"))


def month_number(at: Column) -> Column:
    return (F.year(at) * 12 + F.month(at)).cast("int")


def intervals(events: DataFrame) -> DataFrame:
    """list, verdict, key, valid_from, valid_to (exclusive, null while open)."""
    dated = events.where("list IS NOT NULL AND key IS NOT NULL AND day IS NOT NULL")
    order = F.struct(
        F.coalesce("seq", F.lit(0)).alias("seq"), (F.col("action") == "remove").alias("gone"), F.col("verdict").alias("verdict")
    )
    daily = dated.groupBy("list", "key", "day").agg(F.max_by(F.struct("action", "verdict"), order).alias("event"))
    # whatever it says, the next event of the same list and key ends an entry
    following = Window.partitionBy("list", "key").orderBy("day")
    spans = daily.select("list", "key", "day", "event.*").withColumn("valid_to", F.lead("day").over(following)).where("action = 'add'")
    return spans.select("list", "verdict", "key", F.col("day").alias("valid_from"), "valid_to")


def active_entries(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """uid and entry for every entry that was active when the capture was fetched."""
    wanted = captures.where("at IS NOT NULL").select("uid", "at", month_number(F.col("at")).alias("month"), F.explode("keys").alias("key"))
    low, high = captures.agg(F.min(month_number(F.col("at"))), F.max(month_number(F.col("at")))).first()
    bounded = entries.select(
        "list", "verdict", "key", "valid_from", "valid_to",
        F.greatest(F.lit(low), month_number(F.col("valid_from"))).alias("begin"),
        F.least(F.lit(high), F.coalesce(month_number(F.col("valid_to")), F.lit(high))).alias("end"),
    ).where("begin <= end")
    monthly = bounded.withColumn("month", F.explode(F.sequence("begin", "end"))).drop("begin", "end")
    inside = (F.col("at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to")))
    return wanted.join(monthly, ["key", "month"]).where(inside)


def judged(captures: DataFrame, events: DataFrame, id_column: str, url_column: str, at_column: str) -> DataFrame:
    """One row per capture: id, host, at, n_active, decision, matched (the key that decided)."""
    work = Workspace(captures.sparkSession, "temporal-lists")
    url = F.col(url_column)
    rows = captures.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_column).alias("id"), F.col(at_column).alias("at"),
        F.when(host_of(url) != "", host_of(url)).alias("host"), url_keys(url).alias("keys"),
    )
    rows = work.keep(rows, "captures")
    entries = work.keep(intervals(events), "intervals")
    rank = F.when(F.col("key").startswith("prefix:"), 3).when(F.col("key").startswith("host:"), 2).otherwise(1)
    strength = F.struct(
        rank.alias("rank"), F.length("key").alias("length"), (F.col("verdict") == "block").alias("block"), F.col("key"),
    )
    best = active_entries(rows, entries).groupBy("uid").agg(
        F.count(F.lit(1)).alias("n_active"), F.max(F.struct(strength.alias("s"), F.col("verdict"))).alias("best")
    )
    return rows.select("uid", "id", "host", "at").join(best, "uid", "left").select(
        "id", "host", "at", F.coalesce("n_active", F.lit(0)).alias("n_active"),
        F.coalesce("best.verdict", F.lit("none")).alias("decision"), F.col("best.s.key").alias("matched"),
    )
