"""Toxicity by a classifier chain.

Categories are predicted one after the other; each is a linear model on hashed words and word beginnings of
the whole text, and on the probabilities of all earlier categories. The models see, for training rows, only
out-of-fold probabilities: each earlier category is fitted on the other folds. For scoring, each category
is fitted once on all training rows and takes what the chain has predicted so far.

The label table knows one kind, ``toxic``. The earlier categories are derived for training rows: a toxic text
with a word of the category's list has it (``CATEGORIES``, a parameter); the last category is the label
itself, so texts of languages without lists are learned too.

Training takes at most ``max_rows`` labelled rows (those with the smallest digest of their identifier), which
bounds the one task that fits; everything else covers all rows. The threshold is the one with the best F1 on the
out-of-fold probabilities.

Null and empty texts have no features: they get the models' base probability. Labels that are null, or whose
document is missing, are left out; of several labels of one document the highest counts, and of several texts the
one that sorts first is fitted. With labels of a
single kind the model is a constant. Without labels no text is called toxic. Repeated rows are scored each for itself; an
empty table gives an empty result. Scores are columns, so other columns may have any name.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.linear import LinearModel, Rows, fit, word_features

# Words that make a toxic training text one of the category; the last category is the label.
CATEGORIES: dict[str, tuple[str, ...]] = {
    "insult": ("idiot", "moron", "stupid", "clown", "loser", "pathetic"),
    "contempt": ("scum", "trash", "worthless", "disgusting"),
    "toxic": (),
}
FOLDS = 5
MAX_ROWS = 12_000
TEXTS_AT_ONCE = 500


@dataclass
class Chain:
    names: tuple[str, ...]
    models: list[LinearModel]
    threshold: float

    def probabilities(self, sets: list[np.ndarray]) -> np.ndarray:
        """One column per category, each with the earlier ones among its inputs."""
        found = np.zeros((len(sets), 0))
        for model in self.models:
            found = np.column_stack((found, model.probability(Rows.of(sets, found))))
        return found


def best_threshold(probability: np.ndarray, labels: np.ndarray) -> float:
    """Between the two neighbouring probabilities where F1 is best; 0.5 for labels of one kind, 1 without labels."""
    if not len(labels):
        return 1.0
    if labels.min() == labels.max():
        return 0.5
    order = np.argsort(-probability, kind="stable")
    ranked, hits = probability[order], np.cumsum(labels[order])
    last = np.append(ranked[1:] < ranked[:-1], True)
    score = 2 * hits / (np.arange(1, len(ranked) + 1) + labels.sum())
    place = int(np.argmax(np.where(last, score, -1)))
    below = ranked[place + 1] if place + 1 < len(ranked) else 0.0
    return float(np.sqrt(max(ranked[place], 1e-9) * max(below, 1e-9)))


def fit_chain(sets: list[np.ndarray], labels: np.ndarray, folds: np.ndarray, names: Sequence[str]) -> Chain:
    """``labels`` has a column per category, ``folds`` the fold of each row."""
    models, outside = [], np.zeros((len(sets), 0))
    for place in range(len(names)):
        wanted = labels[:, place]
        models.append(fit(Rows.of(sets, outside), wanted))
        held = np.zeros(len(sets))
        for fold in range(FOLDS):
            inside, out = np.flatnonzero(folds != fold), np.flatnonzero(folds == fold)
            if len(out):
                part = fit(Rows.of([sets[i] for i in inside], outside[inside]), wanted[inside])
                held[out] = part.probability(Rows.of([sets[i] for i in out], outside[out]))
        outside = np.column_stack((outside, held))
    return Chain(tuple(names), models, best_threshold(outside[:, -1], labels[:, -1]))


def features(text: Column) -> Column:
    @F.pandas_udf("array<int>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([word_features(text) for text in texts], dtype="object")

    return found(text)


def train(
    docs: DataFrame, labels: DataFrame, categories: Mapping[str, tuple[str, ...]] = CATEGORIES, max_rows: int = MAX_ROWS,
    id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
) -> Chain:
    """Fit the chain in one task on the bounded training rows, and bring the models (a few thousand weights) here."""
    known = labels.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
    known = known.groupBy(F.col(id_column).alias("id")).agg(F.max(label_column).cast("int").alias("label"))
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    chosen = known.join(docs.select(F.col(id_column).alias("id")).distinct(), "id", "left_semi")
    chosen = chosen.withColumn("digest", F.md5(F.col("id").cast("string"))).orderBy("digest").limit(max_rows)
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+")
    flags = []
    for name, listed in categories.items():
        has = F.arrays_overlap(words, F.array(*map(F.lit, listed))) if listed else F.lit(True)
        flags.append(((F.col("label") == 1) & has).cast("int").alias(f"is_{name}"))
    # at most max_rows short rows: safe to send to every task, so no text but theirs is moved
    found = texts.join(F.broadcast(chosen), "id")
    # of several rows of one identifier the text that sorts first
    rows = found.groupBy("id", "digest", "label").agg(F.min("text").alias("text")).select(
        "digest", F.pmod(F.xxhash64("digest"), F.lit(FOLDS)).cast("int").alias("fold"), F.array(*flags).alias("labels"),
        features(F.col("text")).alias("features"),
    )
    names = tuple(categories)

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(batches)
        if not frames:
            return
        frame = pd.concat(frames).sort_values("digest")
        wanted = np.array(frame["labels"].tolist(), np.int64)
        chain = fit_chain(frame["features"].tolist(), wanted, frame["fold"].to_numpy(), names)
        yield pd.DataFrame({"model": [pickle.dumps(chain)]})

    model = rows.repartition(1).mapInPandas(fitted, "model binary").first()
    return pickle.loads(model[0]) if model else fit_chain([], np.zeros((0, len(names))), np.zeros(0), names)


def scores(text: Column, chain: Chain) -> Column:
    """A struct of one probability per category and ``flagged``."""
    shared = pickle.dumps(chain)
    kind = ", ".join(f"{name} double" for name in chain.names) + ", flagged boolean"

    @F.pandas_udf(kind)
    def scored(texts: pd.Series) -> pd.DataFrame:
        model = pickle.loads(shared)
        found = np.zeros((len(texts), len(model.names)))
        for start in range(0, len(texts), TEXTS_AT_ONCE):  # a few texts' features at a time
            part = texts.iloc[start : start + TEXTS_AT_ONCE]
            found[start : start + len(part)] = model.probabilities([word_features(text) for text in part])
        frame = pd.DataFrame(found, columns=list(model.names))
        frame["flagged"] = found[:, -1] >= model.threshold
        return frame

    return scored(text)
