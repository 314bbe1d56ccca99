"""Periodic runs of words: every maximal stretch that repeats itself, and the text with each run cut to one period.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and a length of
``max(shortest, 2 * q)`` at least, which no neighbouring word extends with that period.

The method is a dictionary of basic factors. Every factor whose length m is a power of two gets a name, equal
for equal factors of one text, from the names of its halves; a factor that occurs once in its text needs no
name, nor do longer ones around it, so ordinary prose is done after a few lengths. The occurrences of a
factor, in order, fall into arithmetic progressions of steps up to m. A progression proposes its step as a
period; two progressions whose members lie within 2 * m of each other propose the distances from all members of
one to the ends of the other. That meets every run: if the first m words of a run of period q, m <= q < 2 * m,
stand at s, they stand at s + q too, in another progression, and either s is the first of its own or s + q the
first of the other. Proposals are extended both ways by comparing names, longest factors first, and
of equal stretches the smallest period stays.

Texts are taken whole, several in one go, inside Arrow functions: a text needs memory in proportion to its words
and nothing is compared across texts. Null and empty texts have no words and no runs; equal rows give equal
results, each for itself; an empty table gives an empty result. The operator adds columns under names
the table does not have, other columns pass through untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import free_name

SHORTEST = 12
# Words of the texts that are taken in one go; a longer text is taken by itself.
GROUP = 200_000
# How many following progressions a progression is paired with. The occurrences that start within m words of each other
# are one progression, so within 2 * m words there are no more; each may share an end with the next.
NEXT = 5
FOUND = (
    "n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
    "collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>, collapsed string"
)


def factor_names(keys: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Names of the factors of 1, 2, 4, ... words at each place, -1 where a factor occurs once in its text.

    ``keys`` has one number per word, equal for equal words of one text and for no others; ``ends`` has the place
    after the last word of each word's text.
    """
    levels, places, key, m = [], np.arange(len(keys)), keys, 1
    while len(places):
        order = np.argsort(key, kind="stable")
        in_order = key[order]
        same = in_order[1:] == in_order[:-1]
        again = np.concatenate((same, [False])) | np.concatenate(([False], same))
        if not again.any():
            break
        fresh = np.concatenate(([True], ~same))
        names = np.full(len(keys), -1, np.int32)
        names[places[order[again]]] = (np.cumsum(fresh) - 1)[again]
        levels.append(names)
        places = np.flatnonzero(names >= 0)
        places = places[places + 2 * m <= ends[places]]
        places = places[names[places + m] >= 0]
        key = names[places].astype(np.int64) * (int(names.max()) + 1) + names[places + m]
        m *= 2
    return levels


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each range's number and every index from its first to its last."""
    sizes = last - first + 1
    owner = np.repeat(np.arange(len(first)), sizes)
    return owner, np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[owner]


def proposals(names: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods that the occurrences of the factors of ``m`` words propose."""
    places = np.flatnonzero(names >= 0)
    places = places[np.argsort(names[places], kind="stable")]
    name, gap = names[places], np.diff(places)
    near = (name[1:] == name[:-1]) & (gap <= 2 * m)
    kept = np.concatenate((near, [False])) | np.concatenate(([False], near))
    places, name = places[kept], name[kept]
    if len(places) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = np.diff(places)
    step = np.where((name[1:] == name[:-1]) & (gap <= m), gap, 0)
    changed = np.concatenate(([True], step[1:] != step[:-1], [True]))
    first = np.flatnonzero((step > 0) & changed[:-1])
    last = np.flatnonzero((step > 0) & changed[1:]) + 1
    alone = np.flatnonzero((np.concatenate(([0], step)) == 0) & (np.concatenate((step, [0])) == 0))
    made_of = [(places[first], step[first])]
    first, last = np.concatenate((first, alone)), np.concatenate((last, alone))
    order = np.lexsort((last, first))
    first, last = first[order], last[order]
    for hop in range(1, NEXT + 1):
        a, b = slice(None, -hop), slice(hop, None)
        pair = (name[first[a]] == name[first[b]]) & (places[first[b]] - places[last[a]] <= 2 * m)
        if not pair.any():
            break
        a_first, a_last, b_first, b_last = first[a][pair], last[a][pair], first[b][pair], last[b][pair]
        owner, member = _spread(a_first, a_last)
        made_of += [(places[member], places[end[owner]] - places[member]) for end in (b_first, b_last)]
        owner, member = _spread(b_first, b_last)
        made_of += [(places[end[owner]], places[member] - places[end[owner]]) for end in (a_first, a_last)]
    at, period = (np.concatenate(part) for part in zip(*made_of))
    fits = (period > 0) & (period <= 2 * m)
    return at[fits], period[fits]


def extend(levels: Sequence[np.ndarray], at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches around the places in which words ``period`` apart are equal: first place, place after the last."""
    size = len(levels[0])
    left, right = at.copy(), at.copy()
    for k in range(len(levels) - 1, -1, -1):
        names, m = levels[k], 1 << k
        here, there = names[np.minimum(right, size - 1)], names[np.minimum(right + period, size - 1)]
        right += m * ((right + period < size) & (here >= 0) & (here == there))
        here, there = names[np.maximum(left - m, 0)], names[np.clip(left - m + period, 0, size - 1)]
        left -= m * ((left >= m) & (here >= 0) & (here == there))
    return left, right + period


def runs(keys: np.ndarray, ends: np.ndarray, shortest: int = SHORTEST) -> np.ndarray:
    """All runs as rows of start, length and period, ordered by start and period."""
    levels = factor_names(keys, ends)
    found = [np.zeros((0, 3), np.int64)]
    for k, names in enumerate(levels):
        at, period = proposals(names, 1 << k)
        if not len(at):
            continue
        # of neighbouring places with one period the first is enough, they lie in one stretch
        order = np.lexsort((at, period))
        at, period = at[order], period[order]
        again = (np.diff(at) <= 1) & (np.diff(period) == 0)
        at, period = at[np.concatenate(([True], ~again))], period[np.concatenate(([True], ~again))]
        start, after = extend(levels, at, period)
        long = after - start >= np.maximum(shortest, 2 * period)
        found.append(np.stack((start[long], after[long], period[long]), axis=1))
    stretches = np.unique(np.concatenate(found), axis=0)
    if len(stretches):
        # a stretch with a smaller period has its multiples as periods as well
        other = (stretches[1:, :2] != stretches[:-1, :2]).any(axis=1)
        stretches = stretches[np.concatenate(([True], other))]
    out = np.stack((stretches[:, 0], stretches[:, 1] - stretches[:, 0], stretches[:, 2]), axis=1)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def collapsed_places(n: int, found: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay when each run keeps its first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, found[:, 0] + found[:, 2], 1)
    np.add.at(edges, found[:, 0] + found[:, 1], -1)
    return np.cumsum(edges[:-1]) == 0


def _keys(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One number per word of all texts, no number in two texts; where each text starts; each word's text's end."""
    sizes = np.array([len(words) for words in texts], np.int64)
    flat = np.empty(int(sizes.sum()), object)
    flat[:] = [word for words in texts for word in words]
    codes, different = pd.factorize(flat)
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(texts)), sizes)
    return text * max(1, len(different)) + codes, ends - sizes, np.repeat(ends, sizes)


def examine(texts: list[list[bytes]], shortest: int = SHORTEST) -> list[np.ndarray]:
    """The runs of each text, given as its words."""
    keys, starts, ends = _keys(texts)
    found = runs(keys, ends, shortest)
    cut = np.searchsorted(found[:, 0], np.append(starts, len(keys)))
    parts = []
    for place, start in enumerate(starts):
        own = found[cut[place] : cut[place + 1]].copy()
        own[:, 0] -= start
        parts.append(own)
    return parts


def _grouped(texts: Iterator[list[bytes]]) -> Iterator[list[list[bytes]]]:
    group, size = [], 0
    for words in texts:
        if group and size + len(words) > GROUP:
            yield group
            group, size = [], 0
        group.append(words)
        size += len(words)
    if group:
        yield group


def _row(words: list[bytes], found: np.ndarray, whole: bool) -> tuple:
    lines = "".join(f"{start},{length},{period}\n" for start, length, period in found.tolist())
    joined = b" ".join(words)
    if len(found):
        stays = collapsed_places(len(words), found)
        joined = b" ".join([words[place] for place in np.flatnonzero(stays).tolist()])
        start, length, period = found[np.lexsort((found[:, 2], found[:, 0], -found[:, 1]))[0]].tolist()
        longest = (start, length, period, 1000 * length // period)
    else:
        longest = (None, None, None, None)
    listed = [dict(zip(("start", "length", "period"), run)) for run in found.tolist()] if whole else None
    return (
        len(words), len(found), *longest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(joined).hexdigest(),
        listed, joined.decode("utf-8", "replace") if whole else None,
    )


_KIND = pa.struct(
    [
        *((name, pa.int64()) for name in ("n_words", "n_runs", "start", "length", "period", "exponent_milli")),
        *((name, pa.string()) for name in ("runs_sha256", "collapsed_sha256")),
        ("runs", pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))),
        ("collapsed", pa.string()),
    ]
)


def periodic_runs(text: Column, shortest: int = SHORTEST, whole: bool = True) -> Column:
    """What ``FOUND`` lists, for a text column, as a struct.

    ``whole`` adds all runs and the collapsed text to their digests.
    """

    @F.arrow_udf(FOUND)
    def found(texts: pa.Array) -> pa.Array:
        names = [field.name for field in _KIND]
        # bytes.split ends words at space, tab, line feed, vertical tab, form feed and carriage return
        all_words = ((text.as_py() or "").encode("utf-8", "surrogatepass").split() for text in texts)
        rows = []
        for group in _grouped(all_words):
            rows += [dict(zip(names, _row(words, own, whole))) for words, own in zip(group, examine(group, shortest))]
        return pa.array(rows, _KIND)

    # the optimiser would put a copy of the call into a filter on its result, and look at every text twice
    return found.asNondeterministic()(text)


def without_repetition(docs: DataFrame, text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """The same rows and columns; texts with runs are replaced by their words, each run cut to one period."""
    name = free_name(docs, "found")
    looked_at = docs.withColumn(name, periodic_runs(F.col(text), shortest=shortest))
    changed = F.when(F.col(name)["n_runs"] > 0, F.col(name)["collapsed"]).otherwise(F.col(text))
    return looked_at.withColumn(text, changed).select(*docs.columns)
