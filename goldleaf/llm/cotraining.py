"""Quality by co-training: two views of a document teach each other.

* The *text* view: hashed words as written, and the endings of words.
* The *page* view: language and source, and the layout: size, lines, and shares of capitals, digits, marks and repetition.
  The tables have no more page metadata than those two, so the layout is measured on the text: counts of bytes, lines, words
  and different words, never which words they are.

Both views of every document are computed once, as packed numbers in a stored table. Fits, rounds and final scores read that
table, not the texts.

Each view starts with a linear model on the labelled rows. In each round both models score every document
without a label; each hands its most confident ones (``per_round`` of either kind, over all documents, and at
least ``sure`` of it) to the other view as pseudo-labelled training rows, and both are fitted anew. At the end each
view is calibrated on labelled rows that no fit has seen, and the calibrated views are combined: their log odds are
added, less the prior that both contain. Every document gets a score.

Fits take at most ``max_rows`` labelled rows (smallest digest of the identifier) plus the pseudo-labelled ones
(4 x ``per_round`` x ``rounds`` at most), so the one task that fits is bounded. Candidates for pseudo-labels are
looked for among all documents.

Null and empty texts have no words and page values of 0; null language or source is a value of its own. Labels
that are null or whose document is missing are left out; of several labels of a document the highest counts, and
of several rows of one identifier the one whose views sort first is fitted. With labels of one kind, or none, models are constants and every document gets the same score.
Repeated rows are scored each for itself; an empty table gives an empty result. Scores are columns, so other
columns may have any name.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import Workspace
from goldleaf.llm.linear import FEATURES, LinearModel, Rows, fit, sigmoid
from goldleaf.llm.words import located_words, mix, text_bytes

MAX_ROWS = 12_000
PER_ROUND = 1_000
ROUNDS = 2
SURE = 0.9
TEXTS_AT_ONCE = 500
ENDINGS = (2, 3)
PAGE = 14
# Packed views: text features, page features, page values.
KINDS = {"text_view": np.int32, "named": np.int32, "values": np.float64}
PACKED = "text_view binary, named binary, `values` binary"


def text_view(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, distinct: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashed words as written, and their last bytes. ``first``: where each distinct word stands first."""
    parts = [distinct]
    starts, ends = starts[first], ends[first]
    for size in ENDINGS:
        last = ends[ends - starts > size]
        value = np.full(len(last), 64 + size, np.uint64)
        for place in range(size):
            value = (value << np.uint64(8)) | data[last - size + place].astype(np.uint64)
        parts.append(mix(value))
    return np.unique(np.concatenate(parts) % np.uint64(FEATURES)).astype(np.int32)


def page_view(data: np.ndarray, words: np.ndarray, n_distinct: int) -> np.ndarray:
    """Size and form of a page, without its words."""
    n, w = len(data), len(words)
    if n == 0:
        return np.zeros(PAGE)
    counts = np.bincount(data, minlength=256)
    lines = counts[10] + 1
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    marks = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    symbols = counts[[ord(c) for c in "#*$%&|<>"]].sum()
    feeds = np.flatnonzero(np.concatenate(([10], data, [10])) == 10)
    widths = np.diff(feeds) - 1
    triples = np.unique(words[:-2] * np.uint64(3) ^ words[1:-1] * np.uint64(5) ^ words[2:] * np.uint64(7))
    return np.array([
        np.log1p(n), np.log1p(w), np.log1p(lines), np.log1p(widths.mean()), (widths < 30).mean(), n / (w + 1),
        upper / (upper + lower + 1), counts[48:58].sum() / n, marks / n, symbols / n, counts[33] / n, counts[46] / (w + 1),
        n_distinct / (w + 1), len(triples) / max(w - 2, 1),
    ])


def name_feature(kind: str, value: object) -> int:
    return zlib.crc32(f"{kind} {'missing' if value is None else 'is ' + str(value)}".encode()) % FEATURES


def views(text: str | None, lang: object, source: object) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text features, page features, page values."""
    data = text_bytes(text)
    starts, ends, words = located_words(data)
    named = np.unique(np.array([name_feature("lang", lang), name_feature("source", source)], np.int32))
    distinct, first = np.unique(words, return_index=True)
    return text_view(data, starts, ends, distinct, first), named, page_view(data, words, len(distinct))


@dataclass
class Calibrated:
    """A view's model and the line that turns its margin into log odds."""

    model: LinearModel
    slope: float = 1.0
    shift: float = 0.0

    def log_odds(self, rows: Rows) -> np.ndarray:
        return self.slope * self.model.margin(rows) + self.shift


def calibration(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the log odds by Newton steps, with soft targets against certainty."""
    if not len(labels) or labels.min() == labels.max():
        return 1.0, 0.0
    ones = labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    inputs = np.column_stack((margins, np.ones(len(margins))))
    beta = np.array([1.0, 0.0])
    for _ in range(30):
        p = sigmoid(inputs @ beta)
        weight = np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve(inputs.T @ (inputs * weight[:, None]) + 1e-6 * np.eye(2), inputs.T @ (p - target))
        beta = beta - np.clip(step, -2, 2)
    return float(max(beta[0], 1e-3)), float(beta[1])


@dataclass
class Pair:
    text: Calibrated
    page: Calibrated
    prior: float

    def probabilities(self, text_rows: Rows, page_rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.text.log_odds(text_rows), self.page.log_odds(page_rows)
        return sigmoid(a), sigmoid(b), sigmoid(a + b - self.prior)


def fit_pair(frame: pd.DataFrame) -> Pair:
    """``role``: 0 labelled, 1 pseudo-labelled for the text view, 2 for the page view; ``held``: for calibration."""
    text_sets, page_sets = frame["text_view"].tolist(), frame["named"].tolist()
    dense = np.array(frame["values"].tolist(), float).reshape(len(frame), PAGE)
    labels, role, held = (frame[name].to_numpy() for name in ("label", "role", "held"))

    def rows(places: np.ndarray, text: bool) -> Rows:
        if text:
            return Rows.of([text_sets[i] for i in places])
        return Rows.of([page_sets[i] for i in places], dense[places])

    check = np.flatnonzero((role == 0) & held)
    fitted = []
    for text in (True, False):
        own = np.flatnonzero(((role == 0) & ~held) | (role == (1 if text else 2)))
        model = fit(rows(own, text), labels[own], least=8.0)
        fitted.append(Calibrated(model, *calibration(model.margin(rows(check, text)), labels[check])))
    ones = labels[check].sum() if len(check) else 0
    prior = float(np.log((ones + 1) / (len(check) - ones + 1)))
    return Pair(*fitted, prior)


def packed_views(text: Column, lang: Column, source: Column) -> Column:
    """The three arrays of ``views`` as bytes; the text features, in rising order, as steps, which compress better."""

    @F.pandas_udf(PACKED)
    def found(texts: pd.Series, langs: pd.Series, sources: pd.Series) -> pd.DataFrame:
        rows = [
            (np.diff(text, prepend=np.int32(0)).tobytes(), named.tobytes(), values.tobytes())
            for text, named, values in (views(*row) for row in zip(texts, langs, sources))
        ]
        return pd.DataFrame(rows, columns=list(KINDS))

    return found.asNondeterministic()(text, lang, source)


def unpack(name: str, data: bytes) -> np.ndarray:
    values = np.frombuffer(data, KINDS[name])
    return np.cumsum(values, dtype=np.int32) if name == "text_view" else values


def unpacked(columns: list[pd.Series], part: slice = slice(None)) -> tuple[Rows, Rows]:
    """Text rows and page rows from packed views."""
    sets, named, dense = ([unpack(name, row) for row in column.iloc[part]] for name, column in zip(KINDS, columns))
    return Rows.of(sets), Rows.of(named, np.array(dense, float).reshape(len(dense), PAGE))


def view_scores(pair: Pair, *packed: Column) -> Column:
    """Scores from packed views."""
    shared = pickle.dumps(pair)

    @F.pandas_udf("text double, page double, both double")
    def scored(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.DataFrame:
        model = pickle.loads(shared)
        found = np.zeros((3, len(a)))
        for start in range(0, len(a), TEXTS_AT_ONCE):  # a few texts' features at a time
            part = slice(start, start + TEXTS_AT_ONCE)
            found[:, part] = model.probabilities(*unpacked([a, b, c], part))
        return pd.DataFrame(dict(zip(("text", "page", "both"), found)))

    return scored(*packed)


def pair_scores(text: Column, lang: Column, source: Column, pair: Pair) -> Column:
    """Scores of documents whose views are not stored."""
    packed = packed_views(text, lang, source)
    return view_scores(pair, *(packed[name] for name in KINDS))


def fitted_pair(rows: DataFrame) -> Pair:
    """Fit in one task. Rows: id, label, role, held and packed views; their number is bounded by the caller."""

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(batches)
        if frames:
            frame = pd.concat(frames).sort_values(["id", "role"])
            for name in KINDS:
                frame[name] = [unpack(name, row) for row in frame[name]]
            yield pd.DataFrame({"model": [pickle.dumps(fit_pair(frame))]})

    model = rows.select("id", "label", "role", "held", *KINDS).repartition(1).mapInPandas(fitted, "model binary").first()
    if model:
        return pickle.loads(model[0])
    none = pd.DataFrame({name: [] for name in ("id", *KINDS, "label", "role", "held")})
    return fit_pair(none.astype({"label": int, "role": int, "held": bool}))


def most_confident(scored: DataFrame, view: str, label: int, sure: float, per_round: int) -> DataFrame:
    """The documents that a view is most sure of, ties by digest."""
    p = F.col(view) if label else 1 - F.col(view)
    return scored.where(p >= sure).orderBy(p.desc(), "digest").limit(per_round)


def cotrained(
    docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, per_round: int = PER_ROUND, sure: float = SURE,
    max_rows: int = MAX_ROWS, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
    source_column: str = "source", label_column: str = "quality",
) -> tuple[Pair, DataFrame]:
    """Both views after the last round, calibrated, and the stored views of all documents beside their ``id``.

    The models (a few thousand weights) come to the driver.
    """
    work = Workspace(docs.sparkSession, "cotraining")
    known = labels.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
    known = known.groupBy(F.col(id_column).alias("id")).agg(F.max(label_column).cast("int").alias("label"))
    packed = packed_views(F.col(text_column), F.col(lang_column).cast("string"), F.col(source_column).cast("string"))
    seen = work.keep(docs.select(F.col(id_column).alias("id"), packed.alias("v")).select("id", "v.*"), "views")
    digest = F.md5(F.col("id").cast("string"))
    present = known.join(seen.select("id").distinct(), "id", "left_semi")
    chosen = present.orderBy(digest).limit(max_rows).select(
        "id", "label", F.lit(0).alias("role"), (F.pmod(F.xxhash64(digest), F.lit(4)) == 0).alias("held"),
        F.lit(-1).alias("turn"),
    )

    def fit_on(ids: DataFrame) -> Pair:
        # what the latest round says of a row counts
        latest = ids.groupBy("id", "role", "held").agg(F.max_by("label", "turn").alias("label"))
        # a bounded number of short rows goes to every task, so only the views that are fitted move
        found = seen.join(F.broadcast(latest), "id")
        # of several rows of one identifier the one that sorts first
        one = found.groupBy("id", "role", "held", "label").agg(F.min(F.struct(*KINDS)).alias("d"))
        return fitted_pair(one.select("id", "role", "held", "label", "d.*"))

    pair = fit_on(chosen)
    given: list[DataFrame] = []
    for turn in range(rounds):
        scored = seen.select("id", view_scores(pair, *(F.col(name) for name in KINDS)).alias("s"))
        scored = work.keep(scored.select("id", digest.alias("digest"), "s.text", "s.page"), "scored")
        # labelled rows leave after scoring: joining slim rows is cheaper than moving views
        scored = work.keep(scored.where("id IS NOT NULL").join(known.select("id"), "id", "left_anti"), "pool")
        for view, role in (("page", 1), ("text", 2)):  # each view teaches the other
            for label in (0, 1):
                best = most_confident(scored, view, label, sure, per_round).select(
                    "id", F.lit(label).alias("label"), F.lit(role).alias("role"), F.lit(False).alias("held"), F.lit(turn).alias("turn")
                )
                given.append(work.keep(best, "taught"))
        rows = chosen
        for part in given:
            rows = rows.union(part)
        pair = fit_on(rows)
    return pair, seen


def cotrain(docs: DataFrame, labels: DataFrame, **settings) -> Pair:
    """The models alone, to score other documents with ``pair_scores``. Settings are those of ``cotrained``."""
    return cotrained(docs, labels, **settings)[0]


def quality_scores(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """``id``, ``text``, ``page`` and ``both``: what the views, and both together, say of every document."""
    pair, seen = cotrained(docs, labels, **settings)
    return seen.select("id", view_scores(pair, *(F.col(name) for name in KINDS)).alias("s")).select("id", "s.*")
