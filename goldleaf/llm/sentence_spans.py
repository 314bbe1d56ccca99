"""Substring deduplication by sliding sentence spans.

A sentence ends with a word that ends in ``.``, ``!``, ``?`` or a mark like these of another script (``MARKS``; a closing
quote or bracket may follow) or at a line feed. Sentences of more than ``LONG`` words are cut after commas, semicolons
and colons too (``PAUSES``).

Sentences that are still longer are searched in smaller *parts*: they are cut after words that their own hash chooses,
one in eight, then one in two where that leaves more than ``LONG`` words, then after every word. Both
copies of a passage are so cut alike, wherever they stand, and all of it is met but for its ends. What is removed of such a
sentence is its parts, so the rest of it stays; it counts as removed when all its parts are. Other sentences go whole.
In what follows, a sentence that is cut is its parts.

A span is a run of several (two at least) consecutive sentences of at least ``min_words`` words together: from every sentence
the shortest such run forwards, and to every sentence the shortest one backwards, so the last sentences of a
repeated passage are covered as well as the first. White space does not count; words must agree exactly.

All spans are joined globally by the hash of their words. The occurrence with the smallest identifier (and, in
one text, the earliest) is the first; every other one is marked, and each sentence that a marked span covers is
removed. Sentences outside stay as they are.

Null and empty texts have no sentences. Rows without identifier come last; of rows with the same identifier only
the first stored one can hold a first occurrence. Texts with fewer than ``min_words`` words, or one sentence, have no span and stay
whole. Texts are read whole, without limits on spans per text or occurrences per span. An empty table gives an
empty result. Only identifier and text are read, so other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import Workspace
from goldleaf.llm.words import located_words, run_hashes, text_bytes

MIN_WORDS = 15
LONG = 20
# ends of sentences, pauses inside them, and what may follow an end
MARKS = ".!?\u3002\uff0e\uff01\uff1f\uff61\u0964\u0965\u061f\u06d4\u2026\u203c\u2047\u2048\u2049\u0589\u1362\u1367\u104b\u17d4\u037e"
PAUSES = ",;:\uff0c\u3001\uff1b\uff1a\uff64\u060c\u061b\u1363\u1364\u1365"
CLOSING = "\"')]\u201d\u2019\u00bb\u203a\u300d\u300f\uff09\u3011\u300b"


def ending(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, marks: str) -> np.ndarray:
    """Bytes of the mark that each word, from ``starts`` to ``ends``, ends with; 0 without one."""
    ascii_marks = np.zeros(256, bool)
    ascii_marks[[ord(mark) for mark in marks if mark < "\x80"]] = True
    empty = ends <= starts
    last = data[np.maximum(ends, starts + 1) - 1]
    found = np.where(ascii_marks[last] & ~empty, 1, 0)
    others = np.flatnonzero((last >= 0x80) & ~empty)
    if len(others):
        at, room = ends[others], (ends - starts)[others]
        codes = {size: [int.from_bytes(mark.encode(), "big") for mark in marks if len(mark.encode()) == size] for size in (2, 3)}
        for size, wanted in codes.items():
            value = np.zeros(len(others), np.int64)
            for back in range(size, 0, -1):
                value = value << 8 | data[np.maximum(at - back, 0)]
            found[others[(room >= size) & np.isin(value, wanted)]] = size
    return found


def sentences(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of each sentence (and, last, the number of words), start byte of each word, word hashes."""
    starts, ends, words = located_words(data)
    if not len(words):
        return np.zeros(1, np.int64), starts, words
    closing = ending(data, starts, ends, CLOSING)
    closes = (ending(data, starts, ends, MARKS) > 0) | ((closing > 0) & (ending(data, starts, ends - closing, MARKS) > 0))
    feeds = np.concatenate(([0], np.cumsum(data == 10)))
    closes[:-1] |= feeds[starts[1:]] > feeds[ends[:-1]]
    closes[-1] = True
    first_words = np.concatenate(([0], np.flatnonzero(closes) + 1))
    sizes = np.diff(first_words)
    if sizes.max() > LONG:
        closes |= np.repeat(sizes > LONG, sizes) & (ending(data, starts, ends, PAUSES) > 0)
        first_words = np.concatenate(([0], np.flatnonzero(closes) + 1))
    return first_words, starts, words


def parts(first_words: np.ndarray, words: np.ndarray) -> np.ndarray:
    """First word of each part (and, last, the number of words)."""
    sizes = np.diff(first_words)
    for chosen in (1, 4, 8):
        if not len(sizes) or sizes.max() <= LONG:
            break
        cut = np.repeat(sizes > LONG, sizes) & (words >> np.uint64(20) & np.uint64(7) < np.uint64(chosen))
        first_words = np.union1d(first_words, np.flatnonzero(cut) + 1)
        sizes = np.diff(first_words)
    return first_words


def spans(text: str | None, min_words: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Hash of each span, and its place: see ``unpacked``. Then how many sentences and words the text has."""
    whole, _, words = sentences(text_bytes(text))
    first_words = parts(whole, words)
    n, size = len(first_words) - 1, (len(whole) - 1, len(words))
    if n < 2 or first_words[-1] < min_words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), *size
    begin = np.arange(n)
    forward = np.maximum(np.searchsorted(first_words, first_words[:-1] + min_words, "left"), begin + 2)
    backward = np.minimum(np.searchsorted(first_words, first_words[1:] - min_words, "right") - 1, begin - 1)
    pairs = np.concatenate((
        np.stack((begin, forward), 1)[forward <= n], np.stack((backward, begin + 1), 1)[backward >= 0],
    ))
    pairs = np.unique(pairs, axis=0)
    hashes = run_hashes(words, first_words[pairs[:, 0]], first_words[pairs[:, 1]]).view(np.int64)
    _, earliest = np.unique(hashes, return_index=True)
    again = np.ones(len(hashes), np.int64)
    again[earliest] = 0
    return hashes, pairs[:, 0] << 32 | pairs[:, 1] << 1 | again, *size


def unpacked(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First part and the one after the last. The lowest bit says that the text had the same span before."""
    return places >> 32, places >> 1 & 0x7FFFFFFF


def span_column(text: Column, min_words: int) -> Column:
    @F.pandas_udf("hash array<long>, place array<long>, n_sentences long, n_words long")
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = [spans(text, min_words) for text in texts]
        return pd.DataFrame(rows, columns=["hash", "place", "n_sentences", "n_words"])

    return found.asNondeterministic()(text)


def without(text: str, places: np.ndarray) -> tuple[str, int, int]:
    """The text without the covered sentences; sentences and words removed."""
    data = text_bytes(text)
    whole, starts, words = sentences(data)
    first_words = parts(whole, words)
    n = len(first_words) - 1
    first, after = unpacked(places)
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, first, 1)
    np.add.at(depth, after, -1)
    gone = np.cumsum(depth)[:n] > 0
    sizes = np.diff(first_words)
    bounds = np.concatenate((starts[first_words[:-1]], [len(data)]))
    bounds[0] = 0
    kept = b"".join(data[bounds[i] : bounds[i + 1]].tobytes() for i in np.flatnonzero(~gone))
    left = np.add.reduceat(~gone, np.searchsorted(first_words, whole[:-1]), dtype=np.int64)
    return kept.decode("utf-8", "surrogatepass"), int((left == 0).sum()), int(sizes[gone].sum())


def cleaned_column(text: Column, marked: Column) -> Column:
    """Of texts with marked spans. Others stay outside: neither their text nor anything of it goes to Python."""
    kind = "clean_text string, removed_sentences long, removed_words long"

    @F.pandas_udf(kind)
    def cleaned(texts: pd.Series, marks: pd.Series) -> pd.DataFrame:
        rows = [(None, 0, 0) if places is None else without(text, places) for text, places in zip(texts, marks)]
        return pd.DataFrame(rows, columns=[field.split()[0] for field in kind.split(", ")])

    return cleaned.asNondeterministic()(F.when(marked.isNotNull(), text), marked)


def deduplicated(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """One row per input row: id, clean_text, n_sentences, n_words, removed_sentences, removed_words."""
    work = Workspace(docs.sparkSession, "sentence-spans")
    texts = work.keep(
        docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_column).alias("id"), F.col(text_column).alias("text")), "texts"
    )
    rows = work.keep(texts.select("uid", "id", span_column(F.col("text"), min_words).alias("s")).select("uid", "id", "s.*"), "spans")
    exploded = rows.select("uid", "id", F.explode(F.arrays_zip("hash", "place")).alias("s"))
    all_spans = exploded.select("uid", "id", "s.*")
    seen = all_spans.groupBy("hash").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    seen = work.keep(seen.select("hash", "first_id"), "repeated")
    # a row that repeats the identifier of an earlier row
    echoes = rows.groupBy("id").agg(F.min("uid").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    echoes = work.keep(
        rows.select("uid", "id").join(echoes, rows["id"].eqNullSafe(echoes["id"])).where("uid <> least").select("uid"), "echoes"
    )
    later = all_spans.join(seen.hint("merge"), "hash").where("place & 1 = 1 OR NOT (id <=> first_id)").select("uid", "place")
    if not echoes.isEmpty():
        later = later.union(all_spans.join(seen, "hash").join(echoes, "uid").select("uid", "place"))
    marked = later.groupBy("uid").agg(F.collect_set("place").alias("marked"))
    facts = rows.select("uid", "n_sentences", "n_words").join(marked.hint("merge"), "uid", "left")
    facts = work.keep(facts, "facts")
    work.drop(rows, seen, echoes)
    found = texts.join(facts.hint("merge"), "uid")
    found = found.select("id", "text", "n_sentences", "n_words", cleaned_column(F.col("text"), F.col("marked")).alias("c"))
    return found.select(
        "id", F.coalesce("c.clean_text", "text", F.lit("")).alias("clean_text"), "n_sentences", "n_words", "c.removed_sentences", "c.removed_words"
    )
