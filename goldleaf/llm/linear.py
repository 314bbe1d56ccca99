"""Sparse binary features of texts, and logistic regression on a bounded number of rows, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from goldleaf.llm.words import located_words, mix, text_bytes

FEATURES = 1 << 18
PREFIXES = (3, 4, 5, 6)
AT_ONCE = 1 << 20
# ASCII that is no letter becomes a space
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def word_features(text: str | None) -> np.ndarray:
    """Which hashed features a text has: its lower-case words, and beginnings of its words by bytes."""
    data = text_bytes((text or "").lower())
    data = np.frombuffer(data.tobytes().translate(_LETTERS), np.uint8)
    starts, ends, words = located_words(data)
    parts = [words]
    for size in PREFIXES:
        long = ends - starts > size
        begin = starts[long]
        value = np.full(len(begin), size, np.uint64)
        for place in range(size):
            value = (value << np.uint64(8)) | data[begin + place].astype(np.uint64)
        parts.append(mix(value))
    return np.unique(np.concatenate(parts) % np.uint64(FEATURES)).astype(np.int32)


def slices(n: int) -> list[slice]:
    """Parts of a long array, so that temporary 64-bit copies stay small."""
    return [slice(start, start + AT_ONCE) for start in range(0, n, AT_ONCE)]


def association(marked: np.ndarray, features: np.ndarray, n1: int, n0: int, size: int) -> np.ndarray:
    """How much each feature tells about the label: the log-likelihood ratio of independence.

    ``marked``: for each feature of each text, whether the text has the label; ``n1`` texts have it, ``n0`` do not.
    """
    n1, n0 = max(n1, 1), max(n0, 1)
    with_label, without = np.zeros(size), np.zeros(size)
    for part in slices(len(features)):
        with_label += np.bincount(features[part][marked[part]], minlength=size)
        without += np.bincount(features[part][~marked[part]], minlength=size)

    def part(observed, expected):
        return np.where(observed > 0, observed * np.log(np.maximum(observed, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    share = (with_label + without) / (n1 + n0)
    score = part(with_label, n1 * share) + part(without, n0 * share)
    score += part(n1 - with_label, n1 * (1 - share)) + part(n0 - without, n0 * (1 - share))
    return 2 * score


@dataclass
class Rows:
    """Feature sets of several texts, one after the other, and dense columns beside them."""

    features: np.ndarray
    sizes: np.ndarray
    dense: np.ndarray

    @staticmethod
    def of(sets: list[np.ndarray], dense: np.ndarray | None = None) -> Rows:
        sizes = np.array([len(one) for one in sets], np.int64)
        joined = np.concatenate(sets) if sets else np.zeros(0, np.int32)
        return Rows(joined, sizes, np.zeros((len(sets), 0)) if dense is None else dense)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)

    def of_names(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the sorted names occur, and in which text."""
        owner, places, owners = self.owner(), [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        for part in slices(len(owner)) if len(names) else []:
            place = np.minimum(np.searchsorted(names, self.features[part]), len(names) - 1)
            known = names[place] == self.features[part]
            places.append(place[known].astype(np.int32))
            owners.append(owner[part][known])
        return np.concatenate(places), np.concatenate(owners)


@dataclass
class LinearModel:
    """Weights of chosen features and of dense columns (scaled by their mean and spread)."""

    names: np.ndarray
    weights: np.ndarray
    dense_weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    bias: float

    def margin(self, rows: Rows) -> np.ndarray:
        place, owner = rows.of_names(self.names)
        total = np.bincount(owner, self.weights[place], len(rows.sizes))
        return total + (rows.dense - self.centre) / self.scale @ self.dense_weights + self.bias

    def probability(self, rows: Rows) -> np.ndarray:
        return sigmoid(self.margin(rows))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(
    rows: Rows, labels: np.ndarray, keep: int = 2048, least: float = 8.0, penalty: float = 1.0, steps: int = 200,
    weight: np.ndarray | None = None,
) -> LinearModel:
    """Logistic regression by accelerated gradient steps on the ``keep`` most telling features.

    With labels of one kind only, the model is a constant.
    """
    n = len(labels)
    labels = labels.astype(float)
    weight = np.ones(n) if weight is None else weight
    centre = rows.dense.mean(axis=0) if n else np.zeros(rows.dense.shape[1])
    scale = np.maximum(rows.dense.std(axis=0), 1e-6) if n else np.ones(rows.dense.shape[1])
    none = np.zeros(0, np.int64)
    if n == 0 or labels.min() == labels.max():
        sure = 0.0 if n == 0 else 6.0 * (2 * labels[0] - 1)
        return LinearModel(none, np.zeros(0), np.zeros(len(scale)), centre, scale, sure)
    ones = int(labels.sum())
    score = association(np.repeat(labels == 1, rows.sizes), rows.features, ones, n - ones, FEATURES)
    best = np.argsort(-score, kind="stable")[:keep]
    names = np.sort(best[score[best] >= least])
    place, owner = rows.of_names(names)
    dense = (rows.dense - centre) / scale
    w, d, b = np.zeros(len(names)), np.zeros(dense.shape[1]), 0.0
    fast = (w, d, b)
    # no row's features can push the curvature over this bound
    width = 1 + np.bincount(owner, minlength=n).max(initial=0) + (dense**2).sum(axis=1).max(initial=0)
    per_feature = np.bincount(place, weight[owner], len(names)) if len(names) else np.zeros(0)
    rate = 4 / (min(width, 60.0))
    step_w = rate / (per_feature + penalty)
    step_d = rate / (weight.sum() + penalty)
    momentum = 1.0
    for _ in range(steps):
        z = np.bincount(owner, fast[0][place], n) + dense @ fast[1] + fast[2]
        error = weight * (sigmoid(z) - labels)
        new_w = fast[0] - step_w * (np.bincount(place, error[owner], len(names)) + penalty * fast[0])
        new_d = fast[1] - step_d * (dense.T @ error + penalty * fast[1])
        new_b = fast[2] - step_d * error.sum()
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        mixing = (momentum - 1) / following
        fast = (new_w + mixing * (new_w - w), new_d + mixing * (new_d - d), new_b + mixing * (new_b - b))
        w, d, b, momentum = new_w, new_d, new_b, following
    return LinearModel(names, w, d, centre, scale, float(b))
