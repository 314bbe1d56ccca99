"""Language-model scores by a Brown class-based bigram model.

Words go to classes by exchange clustering; a text's probability is the product of class transitions and word
emissions, P(w | previous) = P(class | previous class) x P(type | class) x P(w | type).

* Tokens are words (A-Z in lower case) and one end per text; ends have a class of their own, and the end of the
  text before is the first word's context.
* Every word seen ``min_count`` times or more has a class of its own, however many there are. All other words, also
  those never seen, share buckets by their length and last bytes; a bucket has a class.
* The ``frequent`` most common words and the buckets (the *types*) find the classes by exchange; until then, the other
  words count as their buckets. Exchange clustering: starting from classes in turn by frequency, each round counts, over the whole training
  corpus, how often every type stands before and after every class. With these counts each type of the
  round's half moves to the class where the likelihood of the class bigrams gains most. Rounds end when the
  likelihood stops growing, and the best classes are kept.
* Then each of the other words that is seen often enough chooses its class by the classes before and after it in the
  whole training corpus: the one where the likelihood gains most. These contexts are a table with a row per word
  and batch of texts, sorted by word; the tasks have only the class matrix. The transitions and sizes of the classes
  are counted afterwards, over the final class of every word.
* Smoothing: class bigrams by absolute discounting, backing off to class frequencies; buckets by half a count;
  words in a bucket by absolute discounting (from the numbers of words seen once and twice), whose mass goes to the
  words never seen, as one event per bucket. Over known words and these events, probabilities sum to one.

All counts cover the whole training corpus: the counts of words (identified by 64-bit hashes) are a stored table that
grows with it, and the contexts go through as many parts by hash as they need to fit a task. The ``frequent`` words,
which would be hot keys there, are in the broadcast model, as are the type-by-class counts that come to the driver.
The exchange itself is a loop over the types on the driver (about 17,000, whatever the input).

Null and empty texts have one token, the end. Rows without identifier belong to the training part. Repeated rows
count and are scored each for itself. Without training texts all words are unknown and the scores still defined. An
empty table gives an empty result. Only identifier and text are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import Workspace
from goldleaf.llm.words import located_words, mix, text_bytes

# Words that are exchanged in rounds; how often a word is seen to have a class of its own.
FREQUENT = 16_000
MIN_COUNT = 3
BUCKETS = 1_024
CLASSES = 40
ROUNDS = 8
DISCOUNT = 0.75
HALF = 0.5
# How many texts of a batch are laid out as 64-bit numbers at a time.
TEXTS_AT_ONCE = 1_000
# Types whose counts travel together.
TYPES_AT_ONCE = 256
# Texts whose places travel together, as a power of two; rarer words (with repeats) in a part; words of a part at a time.
GROUP_BITS = 7
PART_WORDS = 1 << 20
WORDS_AT_ONCE = 8_192
NO_CLASS = 255
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_and_buckets(text: str | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Per word: its hash, and the bucket it is in unless it is frequent."""
    data = np.frombuffer(text_bytes(text).tobytes().translate(_LOWER), np.uint8)
    starts, ends, words = located_words(data)
    value = np.minimum(ends - starts, 8).astype(np.uint64)
    for back in (1, 2):
        byte = data[np.maximum(ends - back, starts)].astype(np.uint64)
        value = (value << np.uint64(8)) | byte
    return words.view(np.int64), (mix(value) % np.uint64(buckets)).astype(np.int16)


@dataclass
class Vocabulary:
    """Types: 0 is the end, then the frequent words by hash, then the buckets."""

    words: np.ndarray
    counts: np.ndarray
    buckets: int

    @property
    def size(self) -> int:
        return 1 + len(self.words) + self.buckets

    @property
    def kind(self) -> str:
        """How types are stored."""
        return "<u2" if self.size < 1 << 16 else "<u4"

    def types(self, words: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return 1 + buckets.astype(np.int64)
        place = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[place] == words, 1 + place, 1 + len(self.words) + buckets)


def phi(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def bigram_likelihood(matrix: np.ndarray) -> float:
    return float(phi(matrix).sum() - phi(matrix.sum(axis=1)).sum() - phi(matrix.sum(axis=0)).sum())


def exchange(
    classes: np.ndarray, matrix: np.ndarray, after: np.ndarray, before: np.ndarray, own: np.ndarray, movers: np.ndarray
) -> np.ndarray:
    """Move each of ``movers`` to its best class. ``after[t, c]``: class c follows type t; ``before``: stands before it;
    ``own``: the type follows itself. The last class is that of the ends, where nothing moves to."""
    classes, m = classes.copy(), matrix.astype(float).copy()
    last = m.shape[0] - 1
    every = np.arange(last)
    for t in movers:
        a, s = classes[t], own[t]
        r, l = after[t].astype(float), before[t].astype(float)  # noqa: E741
        total = r.sum()
        if total + l.sum() == 0:
            continue
        r[a] -= s
        l[a] -= s
        # take the type out of its class
        m[a, :] -= r
        m[:, a] -= l
        m[a, a] -= s
        np.maximum(m, 0, out=m)
        rows, columns = m[:last], m[:, :last].T
        gain = (phi(rows + r) - phi(rows)).sum(axis=1) + (phi(columns + l) - phi(columns)).sum(axis=1)
        inner = m[every, every]
        gain += phi(inner + r[:last] + l[:last] + s) + phi(inner) - phi(inner + r[:last]) - phi(inner + l[:last])
        for sums, more in ((m.sum(axis=1)[:last], r.sum() + s), (m.sum(axis=0)[:last], l.sum() + s)):
            gain -= phi(sums + more) - phi(sums)
        b = int(np.argmax(gain))
        if gain[b] <= gain[a] + 1e-9:
            b = a
        m[b, :] += r
        m[:, b] += l
        m[b, b] += s
        classes[t] = b
    return classes


@dataclass
class Model:
    vocabulary: Vocabulary
    # of each type
    classes: np.ndarray
    # class bigrams of the types, as exchanged
    matrix: np.ndarray
    # per bucket: its tokens, and log10 of them and of the mass of its unseen words (both 0 for empty buckets)
    bucket_tokens: np.ndarray
    bucket_total: np.ndarray
    bucket_unseen: np.ndarray
    discount: float
    train_tokens: int
    train_types: int
    ends: int
    likelihoods: list[float] = field(default_factory=list)

    @property
    def first_bucket(self) -> int:
        return 1 + len(self.vocabulary.words)


def count_words(training: DataFrame, buckets: int) -> DataFrame:
    """w, bucket, c: every training word, counted per batch first."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [words_and_buckets(text, buckets) for text in batch["text"]]
            words = np.concatenate([one[0] for one in found]) if found else np.zeros(0, np.int64)
            places = np.concatenate([one[1] for one in found]) if found else np.zeros(0, np.int16)
            unique, first, counts = np.unique(words, return_index=True, return_counts=True)
            yield pd.DataFrame({"w": unique, "bucket": places[first], "c": counts})

    rows = training.select("text").mapInPandas(counted, "w long, bucket short, c long")
    return rows.groupBy("w").agg(F.first("bucket").alias("bucket"), F.sum("c").alias("c"))


def packed(values: np.ndarray, kind: str) -> bytes:
    """Small numbers as few bytes, for a shuffle."""
    return zlib.compress(values.astype(kind).tobytes(), 1)


def unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind).astype(np.int64)


def joined(columns: pd.Series, kind: str) -> np.ndarray:
    """Stored numbers of several rows, one after the other."""
    return np.frombuffer(b"".join(columns), kind).astype(np.int64)


def class_contexts(sequences: DataFrame, classes: np.ndarray, n_classes: int, kind: str) -> tuple[np.ndarray, ...]:
    """after, before (type by class) and own, summed over the corpus. Types and classes are bounded parameters."""
    n_types = len(classes)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        after, before = np.zeros(n_types * n_classes, np.int64), np.zeros(n_types * n_classes, np.int64)
        own, seen = np.zeros(n_types, np.int64), False
        for batch in batches:
            for start in range(0, len(batch), TEXTS_AT_ONCE):
                # texts end with type 0, so one long row of texts has the right neighbours
                cur = joined(batch["types"].iloc[start : start + TEXTS_AT_ONCE], kind)
                prev = np.concatenate(([0], cur[:-1]))
                after += np.bincount(prev * n_classes + classes[cur], minlength=len(after))
                before += np.bincount(cur * n_classes + classes[prev], minlength=len(before))
                own += np.bincount(cur[cur == prev], minlength=n_types)
            seen = True
        if seen:
            both = np.concatenate((after.reshape(n_types, -1), before.reshape(n_types, -1), own[:, None]), axis=1)
            for block, first in enumerate(range(0, n_types, TYPES_AT_ONCE)):
                part = both[first : first + TYPES_AT_ONCE]
                if part.any():
                    yield pd.DataFrame({"block": [block], "counts": [packed(part, "<u4")]})

    def summed(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(unpacked(counts, "<u4") for counts in group["counts"])
        return pd.DataFrame({"block": group["block"].iloc[:1], "counts": [total.astype("<i8").tobytes()]})

    parts = sequences.select("types").mapInPandas(counted, "block long, counts binary")
    rows = parts.groupBy("block").applyInPandas(summed, "block long, counts binary").collect()
    table = np.zeros((n_types, 2 * n_classes + 1), np.int64)
    for block, counts in rows:
        first = block * TYPES_AT_ONCE
        table[first : first + TYPES_AT_ONCE] = np.frombuffer(counts, "<i8").reshape(-1, table.shape[1])
    return table[:, :n_classes], table[:, n_classes : 2 * n_classes], table[:, -1]


def cluster(sequences: DataFrame, vocabulary: Vocabulary, n_classes: int, rounds: int):
    """classes, class bigram matrix, type counts, and the likelihood after each round."""
    n_types = vocabulary.size
    classes = np.full(n_types, n_classes)
    weight = np.concatenate(([0], vocabulary.counts, np.zeros(vocabulary.buckets)))
    order = 1 + np.argsort(-weight[1:], kind="stable")
    classes[order] = np.arange(n_types - 1) % n_classes
    best, likelihoods = None, []
    for turn in range(rounds + 1):
        after, before, own = class_contexts(sequences, classes, n_classes + 1, vocabulary.kind)
        matrix = np.zeros((n_classes + 1, n_classes + 1))
        np.add.at(matrix, classes, after)
        likelihoods.append(bigram_likelihood(matrix))
        if best is None or likelihoods[-1] > best[0]:
            best = (likelihoods[-1], classes, matrix, before.sum(axis=1))
        elif turn > 2 and likelihoods[-1] < best[0] - 1e-3 * abs(best[0]):
            break
        if turn == rounds:
            break
        # half of the types move in a round: neighbours do not all move at once
        movers = order if turn == 0 else order[mix(order.astype(np.uint64)) % np.uint64(2) == turn % 2]
        moved = exchange(classes, matrix, after, before, own, movers)
        if (moved == classes).all():
            break
        classes = moved
    return best[1], best[2], best[3], likelihoods


def transition_table(matrix: np.ndarray) -> np.ndarray:
    """log10 probabilities of class after class, smoothed."""
    n = matrix.shape[0]
    single = (matrix.sum(axis=0) + HALF) / (matrix.sum() + HALF * n)
    rows = matrix.sum(axis=1, keepdims=True)
    kept = np.maximum(matrix - DISCOUNT, 0)
    free = rows - kept.sum(axis=1, keepdims=True)
    return np.log10(np.where(rows > 0, (kept + free * single) / np.maximum(rows, 1), single))


def layout(text: Column, vocabulary: Vocabulary) -> Column:
    """The types of a text's words and end. Of words that are not frequent also ``place``, the number of each in ``w``,
    their different hashes, and how many there are with repeats."""

    @F.pandas_udf("types binary, place binary, w binary, n_rare long")
    def laid(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            words, buckets = words_and_buckets(text, vocabulary.buckets)
            types = vocabulary.types(words, buckets)
            unique, place = np.unique(words[types > len(vocabulary.words)], return_inverse=True)
            kind = "<u2" if len(unique) < 1 << 16 else "<u4"
            rows.append((
                np.append(types, 0).astype(vocabulary.kind).tobytes(), place.astype(kind).tobytes(), unique.astype("<i8").tobytes(), len(place)
            ))
        return pd.DataFrame(rows, columns=["types", "place", "w", "n_rare"])

    return laid.asNondeterministic()(text)


def places_of(data: bytes, n: int) -> np.ndarray:
    """``place`` of ``n`` words."""
    return np.frombuffer(data, "<u4" if len(data) == 4 * n else "<u2").astype(np.int64)


def frequent_words(counts: DataFrame, frequent: int, min_count: int, buckets: int) -> Vocabulary:
    top = counts.where(F.col("c") >= min_count).orderBy(F.desc("c"), "w").limit(frequent).collect()
    top = np.array([(row["w"], row["c"]) for row in top], np.int64).reshape(-1, 2)
    top = top[np.argsort(top[:, 0])]
    return Vocabulary(top[:, 0].copy(), top[:, 1].copy(), buckets)


def train(
    sequences: DataFrame, counts: DataFrame, vocabulary: Vocabulary, n_classes: int, rounds: int, min_count: int
) -> Model:
    """Fit on the laid-out training texts with their stored word counts."""
    classes, matrix, type_counts, likelihoods = cluster(sequences, vocabulary, n_classes, rounds)
    # words without a class of their own, by bucket; at most ``buckets`` rows come here
    rare = counts.where(F.col("c") < min_count).groupBy("bucket").agg(
        F.sum("c").alias("tokens"), F.count(F.lit(1)).alias("types"),
        F.sum((F.col("c") == 1).cast("long")).alias("once"), F.sum((F.col("c") == 2).cast("long")).alias("twice"),
    ).collect()
    once, twice = sum(row["once"] for row in rare), sum(row["twice"] for row in rare)
    discount = min(max((once + 1) / (once + 2 * twice + 2), 0.05), 0.95)
    tokens, total, unseen = (np.zeros(vocabulary.buckets) for _ in range(3))
    for row in rare:
        tokens[row["bucket"]] = row["tokens"]
        total[row["bucket"]] = np.log10(row["tokens"])
        unseen[row["bucket"]] = np.log10(discount * row["types"])
    facts = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = int(type_counts[0])
    return Model(
        vocabulary, classes, matrix, tokens, total, unseen, discount, (facts["n"] or 0) + ends,
        facts["v"] + (1 if ends else 0), ends, likelihoods,
    )


def best_classes(after: np.ndarray, before: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """For each word (row), the class where the likelihood gains most by its contexts. The last class is that of the ends."""
    last = matrix.shape[0] - 1
    logs = transition_table(matrix) * np.log(10)
    sizes, counts = matrix.sum(axis=0)[:last], after.sum(axis=1, keepdims=True)
    gain = before @ logs[:, :last] + after @ logs[:last].T
    return np.argmax(gain - (phi(sizes + counts) - phi(sizes)), axis=1)


# Of one group of texts, the words of one part: each hash, and how many texts have it; per text with the word its number in
# the group, the word's place in its list and the number of contexts; and the contexts.
PLACES = "part int, grp long, w binary, texts binary, local binary, place binary, often binary, around binary"
TOLD = "grp long, local binary, place binary, c binary, class binary"


def word_places(rows: DataFrame, model: Model, parts: int) -> DataFrame:
    """All rarer words of all texts with the classes around them, by part of their hash. Held-out texts have places but
    no contexts."""
    classes, first_bucket, kind, n = model.classes, model.first_bucket, model.vocabulary.kind, model.matrix.shape[0]

    def of_group(group: int, texts: pd.DataFrame) -> Iterator[tuple]:
        sizes = np.array([len(one) // np.dtype(kind).itemsize for one in texts["types"]])
        cur = joined(texts["types"], kind)
        own, rare = classes[cur], np.flatnonzero(cur >= first_bucket)
        words = joined(texts["w"], "<i8")
        if not len(words):
            return
        lengths = np.array([len(one) // 8 for one in texts["w"]])
        offsets = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(texts)), sizes)[rare]
        listed = offsets[owner] + np.concatenate([places_of(*one) for one in zip(texts["place"], texts["n_rare"])])
        # an end stands before the first word and after each last one
        around = np.where(rare > 0, own[rare - 1], n - 1) * n + own[np.minimum(rare + 1, len(own) - 1)]
        counts = ~texts["held_out"].to_numpy(bool)[owner]
        listed, around = listed[counts], around[counts]
        local = np.repeat(texts["uid"].to_numpy() & ((1 << GROUP_BITS) - 1), lengths)
        place = np.arange(len(words)) - np.repeat(offsets, lengths)
        part = ((words.view(np.uint64) >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((words, part))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        around = around[np.argsort(rank[listed], kind="stable")]
        often = np.bincount(rank[listed], minlength=len(order))
        words, part, local, place = words[order], part[order], local[order], place[order]
        fresh = np.concatenate(([True], words[1:] != words[:-1]))
        heads = np.flatnonzero(fresh)
        texts_of = np.diff(np.append(heads, len(words)))
        upto = np.concatenate(([0], np.cumsum(often)))
        cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            x, y = np.searchsorted(heads, (a, b))
            yield (
                int(part[a]), group, words[heads[x:y]].tobytes(), packed(texts_of[x:y], "<u2"), packed(local[a:b], "u1"),
                packed(place[a:b], "<u4"), packed(often[a:b], "<u4"), packed(around[upto[a] : upto[b]], "<u2"),
            )

    def gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in PLACES.split(", ")]
        for batch in batches:
            for group, texts in batch.groupby(batch["uid"].to_numpy() >> GROUP_BITS):
                yield pd.DataFrame(list(of_group(int(group), texts)), columns=names)

    return rows.select("uid", "held_out", "types", "place", "w", "n_rare").mapInPandas(gathered, PLACES)


def part_classes(words: np.ndarray, around: np.ndarray, n_words: int, matrix: np.ndarray, min_count: int):
    """Counts and classes (-1: too rare) of the words of a part, from the number of the word that each context is of."""
    n, c = matrix.shape[0], np.bincount(words, minlength=n_words)
    best = np.full(n_words, -1)
    order = np.argsort(words, kind="stable")
    words, around = words[order], around[order]
    upto = np.concatenate(([0], np.cumsum(c)))
    for start in range(0, n_words, WORDS_AT_ONCE):
        stop = min(start + WORDS_AT_ONCE, n_words)
        cell, near = (words[upto[start] : upto[stop]] - start) * n, around[upto[start] : upto[stop]]
        after, before = (
            np.bincount(cell + side, minlength=(stop - start) * n).reshape(-1, n) for side in (near % n, near // n)
        )
        often = c[start:stop] >= min_count
        best[start:stop][often] = best_classes(after[often], before[often], matrix)
    return c, best


def told_places(places: DataFrame, matrix: np.ndarray, min_count: int) -> DataFrame:
    """For each group of texts: at which places words stand that have a class, or another count than a word that its
    text alone has once (1 in training texts, 0 in held-out ones)."""

    def told(rows: pd.DataFrame) -> pd.DataFrame:
        unique, word = np.unique(joined(rows["w"], "<i8"), return_inverse=True)
        texts, local, place, often, around = (
            [unpacked(one, kind) for one in rows[name]]
            for name, kind in (("texts", "<u2"), ("local", "u1"), ("place", "<u4"), ("often", "<u4"), ("around", "<u2"))
        )
        ends = np.cumsum([len(one) for one in local])
        local, place, often = np.concatenate(local), np.concatenate(place), np.concatenate(often)
        word = np.repeat(word, np.concatenate(texts))
        c, best = part_classes(np.repeat(word, often), np.concatenate(around), len(unique), matrix, min_count)
        c, best = c[word], best[word]
        news = (best >= 0) | (c != (often > 0))
        out = []
        for group, a, b in zip(rows["grp"], np.append(0, ends[:-1]), ends):
            keep = a + np.flatnonzero(news[a:b])
            classes = np.where(best[keep] < 0, NO_CLASS, best[keep])
            out.append((
                group, local[keep].astype("u1").tobytes(), place[keep].astype("<u4").tobytes(), c[keep].astype("<u4").tobytes(),
                classes.astype("u1").tobytes(),
            ))
        return pd.DataFrame(out, columns=[field.split()[0] for field in TOLD.split(", ")])

    return places.groupBy("part").applyInPandas(told, TOLD)


def resolve(model: Model):
    """Laid-out texts of a group and what is told of their places, to: the classes of their tokens, and what hangs on no
    class: tokens, known ones, base score, the emissions before they are divided by the sizes of the classes."""
    n_frequent, first_bucket, kind = len(model.vocabulary.words), model.first_bucket, model.vocabulary.kind
    counts = np.concatenate(([0], model.vocabulary.counts)).astype(float)
    own, base = np.log10(np.maximum(counts, 1)), np.log10(counts + 1)
    own[0] = np.log10(model.ends + HALF)
    bucket_own = np.log10(model.bucket_tokens + HALF) - model.bucket_total

    def of_text(types: np.ndarray, places: bytes, held_out: bool, place: np.ndarray, c: np.ndarray, kinds: np.ndarray) -> tuple:
        rare, common = types[types >= first_bucket] - first_bucket, types[types < first_bucket]
        listed = places_of(places, len(rare))
        bucket = np.zeros(int(listed.max()) + 1 if len(listed) else 0, np.int64)
        bucket[listed] = rare
        seen, group = np.full(len(bucket), 0 if held_out else 1), np.full(len(bucket), NO_CLASS)
        seen[place], group[place] = c, kinds
        single = group == NO_CLASS
        emitted = np.log10(np.maximum(seen - np.where(single, model.discount, 0), 0.01))
        emitted = np.where(seen > 0, emitted, model.bucket_unseen[bucket]) + np.where(single, bucket_own[bucket], 0)
        group = np.where(single, model.classes[first_bucket + bucket], group)
        classes = np.zeros(len(types), "u1")
        classes[types >= first_bucket], classes[types < first_bucket] = group[listed], model.classes[common]
        return (
            len(types), int((common > 0).sum()) + int((seen[listed] > 0).sum()),
            float(base[common].sum() + np.log10(seen[listed] + 1).sum()), float(own[common].sum() + emitted[listed].sum()),
            classes.tobytes(),
        )

    def resolved(texts: pa.Table, told: pa.Table) -> pa.Table:
        local, place, c, kinds = (
            joined(told.column(name).to_pylist(), one) for name, one in (("local", "u1"), ("place", "<u4"), ("c", "<u4"), ("class", "u1"))
        )
        order = np.argsort(local, kind="stable")
        local, place, c, kinds = local[order], place[order], c[order], kinds[order]
        rows = []
        for uid, held_out, types, places in zip(*(texts.column(name).to_pylist() for name in ("uid", "held_out", "types", "place"))):
            a, b = np.searchsorted(local, uid & ((1 << GROUP_BITS) - 1), "left"), np.searchsorted(local, uid & ((1 << GROUP_BITS) - 1), "right")
            rows.append(of_text(np.frombuffer(types, kind).astype(np.int64), places, held_out, place[a:b], c[a:b], kinds[a:b]))
        new = list(zip(*rows)) if rows else [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
        out = texts.select(["id", "held_out"])
        for name, values, one in zip(("n_tokens", "known", "base", "own", "classes"), new, kinds):
            out = out.append_column(name, pa.array(list(values), one))
        return out

    return resolved


def class_bigrams(texts: DataFrame, n: int) -> np.ndarray:
    """How often each class follows each, in the texts' ``classes``."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(n * n, np.int64)
        for batch in batches:
            for start in range(0, len(batch), TEXTS_AT_ONCE):
                cur = np.frombuffer(b"".join(batch["classes"].iloc[start : start + TEXTS_AT_ONCE]), "u1").astype(np.int64)
                total += np.bincount(np.concatenate(([n - 1], cur[:-1])) * n + cur, minlength=n * n)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"pair": used, "c": total[used]})

    pairs = texts.select("classes").mapInPandas(counted, "pair long, c long").groupBy("pair").agg(F.sum("c").alias("c"))
    matrix = np.zeros(n * n)
    for pair, c in pairs.collect():
        matrix[pair] = c
    return matrix.reshape(n, n)


def score_column(model: Model, matrix: np.ndarray) -> Column:
    """log10 probability of a resolved text."""
    n = matrix.shape[0]
    transitions = transition_table(matrix)
    sizes = matrix.sum(axis=0) + HALF * np.bincount(model.classes[model.first_bucket :], minlength=n)
    sizes[-1] += HALF
    steps = (transitions - np.log10(np.maximum(sizes, 1e-300))).ravel()

    @F.pandas_udf("double")
    def scored(classes: pd.Series, own: pd.Series) -> pd.Series:
        sums = []
        for text in classes:
            cur = np.frombuffer(text, "u1").astype(np.int64)
            sums.append(steps[np.concatenate(([n - 1], cur[:-1])) * n + cur].sum())
        return own + np.array(sums, float)

    return scored("classes", "own")


def scores(
    docs: DataFrame, in_training: Column, id_column: str = "doc_id", text_column: str = "text", frequent: int = FREQUENT,
    buckets: int = BUCKETS, n_classes: int = CLASSES, rounds: int = ROUNDS, min_count: int = MIN_COUNT,
) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    if not 0 < n_classes < 256:
        raise ValueError("classes are stored as bytes: 1 to 255")
    work = Workspace(docs.sparkSession, "brown-lm")
    training = docs.where(in_training).select(F.col(text_column).alias("text"))
    counts = work.keep(count_words(training, buckets), "counts")
    vocabulary = frequent_words(counts, frequent, min_count, buckets)
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_column).alias("id"), (~in_training).alias("held_out"),
        layout(F.col(text_column), vocabulary).alias("p"),
    )
    rows = work.keep(rows.select("uid", "id", "held_out", "p.*"), "layout")
    model = train(rows.where("NOT held_out"), counts, vocabulary, n_classes, rounds, min_count)
    work.drop(counts)
    rare = rows.agg(F.sum("n_rare")).first()[0] or 0
    places = word_places(rows, model, max(8, -(-rare // PART_WORDS)))
    told = work.keep(told_places(places, model.matrix, min_count), "told")
    group = F.shiftright("uid", GROUP_BITS).alias("grp")
    texts = rows.select(group, "uid", "id", "held_out", "types", "place").groupBy("grp").cogroup(told.groupBy("grp"))
    kind = rows.schema["id"].dataType.simpleString()
    texts = texts.applyInArrow(
        resolve(model), f"id {kind}, held_out boolean, n_tokens long, known long, base double, own double, classes binary"
    )
    texts = work.keep(texts, "classes")
    work.drop(rows, told)
    matrix = class_bigrams(texts.where("NOT held_out"), n_classes + 1)
    n, v = model.train_tokens, model.train_types
    end_base = float(np.log10(model.ends + 1))
    rows = texts.withColumn("score", score_column(model, matrix))
    return rows.select(
        "id", "held_out", "n_tokens", (F.col("known") + F.lit(1 if model.ends else 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + end_base - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
