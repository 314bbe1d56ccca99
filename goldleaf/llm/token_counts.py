"""How many tokens each text has, under the vocabulary of a public tokenizer.

Texts are encoded in batches inside Arrow functions, and only the lengths come back. A batch holds about the same number
of bytes whatever the texts are: texts longer than a piece are split first, at safe boundaries, and pieces are
put together until a batch is full. So a worker holds the encodings of one batch at a time, a long text
as little as many short ones. Inside a batch pieces are split at every safe boundary, and what is equal is encoded once; a
worker keeps the lengths of a bounded number of short parts for its next batches.

A boundary is safe where a visible ASCII character is followed by ASCII white space: the pre-tokenizers of the supported
files (``.json``, BPE over words) end a word there, no character composes with one across it, and no special token
has white space inside. The white space goes to the later piece. A stretch without a boundary stays whole, however long.

Null counts as empty: no bytes, no tokens. Empty texts have none either. Special tokens are neither added nor, where a
text spells one out, treated otherwise than the library does by default. Nothing is cut or padded. Equal rows
are counted each for itself; an empty table gives an empty result. New columns take names that the table does not have,
all others pass through untouched.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import free_name

# Bytes: texts of more are split into pieces of about this size, and pieces are encoded in batches of that size.
PIECE = 1 << 16
BATCH = 1 << 19
BOUNDARY = re.compile(rb"[\x21-\x7E](?=[\x20\x09-\x0D])")
PARTS = re.compile(r"(?<=[\x21-\x7E])(?=[\x20\x09-\x0D])")
# Parts whose lengths a worker keeps at most, and characters of such a part.
KEPT, SHORT = 1 << 18, 64
_loaded: dict[str, object] = {}
_known: dict[str, dict[str, int]] = {}


def tokenizer(vocabulary: str):
    """The library's tokenizer for a ``.json`` file, loaded once per worker, without threads of its own."""
    if vocabulary not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(vocabulary)
        made.no_truncation()
        made.no_padding()
        _loaded[vocabulary] = made
    return _loaded[vocabulary]


def pieces(text: str, size: int = PIECE) -> list[str]:
    """A text in pieces of about ``size`` bytes or more, which together have the tokens of the whole."""
    if len(text) * 4 <= size or len(data := text.encode("utf-8", "surrogatepass")) <= size:
        return [text]
    parts, start = [], 0
    while start < len(data):
        found = BOUNDARY.search(data, start + size) if start + size < len(data) else None
        end = found.end() if found else len(data)
        parts.append(data[start:end].decode("utf-8", "surrogatepass"))
        start = end
    return parts


def batches(texts: Iterable[str], piece: int = PIECE, batch: int = BATCH) -> Iterator[tuple[list[int], list[str]]]:
    """Pieces in batches of about ``batch`` bytes, each beside the number of its text."""
    owners, parts, size = [], [], 0
    for owner, text in enumerate(texts):
        for part in pieces(text, piece):
            owners.append(owner)
            parts.append(part)
            size += len(part) if part.isascii() else len(part.encode("utf-8", "surrogatepass"))
            if size >= batch:
                yield owners, parts
                owners, parts, size = [], [], 0
    if parts:
        yield owners, parts


def lengths(texts: list[str], vocabulary: str, piece: int = PIECE, batch: int = BATCH) -> np.ndarray:
    """The number of tokens of each text."""
    encode, known = tokenizer(vocabulary).encode_batch_fast, _known.setdefault(vocabulary, {})
    out = np.zeros(len(texts), np.int64)
    for owners, whole in batches(texts, piece, batch):
        split = [PARTS.split(part) for part in whole]
        fresh = list(set().union(*split) - known.keys())
        sizes = dict(zip(fresh, map(len, encode(fresh, add_special_tokens=False))))
        if len(known) + len(fresh) > KEPT:
            sizes.update((part, known[part]) for part in set().union(*split) & known.keys())
            known.clear()
        known.update(sizes)
        np.add.at(out, owners, [sum(map(known.__getitem__, parts)) for parts in split])
        for part in fresh:
            if len(part) > SHORT:
                del known[part]
    return out


def token_count(text: Column, vocabulary: str) -> Column:
    """The number of tokens of a text column."""

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        return pa.array(lengths([text or "" for text in texts.to_pylist()], vocabulary))

    # the optimiser would put a copy of the call into a filter on its result, and encode every text twice
    return counted.asNondeterministic()(text)


def with_token_counts(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """The rows with ``n_bytes`` (UTF-8) and ``n_tokens``, or these names behind underscores where they are taken."""
    sizes = docs.withColumn(free_name(docs, "n_bytes"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
    return sizes.withColumn(free_name(docs, "n_tokens"), token_count(F.col(text), vocabulary))
