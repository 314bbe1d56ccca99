"""Words of a text as arrays of 64-bit hashes.

A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
Everything here works on one text at a time inside a task.
"""

from __future__ import annotations

import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
# Bytes hashed at once; longer texts are taken in parts that end between words.
CHUNK = 1 << 20
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 4096)
        steps = np.full(size, _BASE, np.uint64)
        steps[0] = 1
        back = np.full(size, _BASE_INVERSE, np.uint64)
        back[0] = 1
        _powers, _inverses = np.cumprod(steps), np.cumprod(back)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values: close inputs give unrelated outputs."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def is_gap(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def located_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word starts and ends in the UTF-8 bytes, and its hash, which hangs on its bytes alone."""
    if len(data) <= CHUNK:
        return _located(data, 0)
    parts, start = [], 0
    while start < len(data):
        end = min(start + CHUNK, len(data))
        while end < len(data) and not (data[end] == 32 or 9 <= data[end] <= 13):
            end += 1
        parts.append(_located(data[start:end], start))
        start = end
    return tuple(np.concatenate(part) for part in zip(*parts))


def _located(data: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    edges = np.diff(np.concatenate(([1], is_gap(data).astype(np.int8), [1])))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    _grow(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[: len(data)], out=sums[1:])
    return starts + shift, ends + shift, mix((sums[ends] - sums[starts]) * _inverses[starts])


def word_hashes(text: str | None) -> np.ndarray:
    """One hash per word, in order."""
    return located_words(text_bytes(text))[2]


def run_hashes(words: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """One hash per run of words: from place ``first`` up to, not including, place ``after``."""
    _grow(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _powers[: len(words)], out=sums[1:])
    return mix((sums[after] - sums[first]) * _inverses[first] + (after - first).astype(np.uint64))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash per window of ``size`` consecutive words.

    A text of fewer words, but at least one, has a single window that holds all of them.
    """
    n = len(words)
    if n == 0:
        return words
    width = min(size, n)
    count = n - width + 1
    total = np.full(count, width, np.uint64)
    for place in range(width):
        total *= np.uint64(0xD6E8FEB86659FD93)
        total += words[place : place + count]
        total ^= total >> np.uint64(29)
    return mix(total)


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """The sorted set of a text's word windows, as hashes."""
    return np.unique(window_hashes(word_hashes(text), size))
