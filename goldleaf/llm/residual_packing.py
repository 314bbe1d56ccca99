"""Hierarchical residual packing of tokenised documents into sequences of fixed length.

1. Each partition tokenises its documents, cuts those longer than a sequence, and packs its pieces
   best-fit, longest first. Nearly full bins are finished there; underfull ones are taken apart again.
2. What was in underfull bins goes up a tree: eight neighbours meet in one task, which packs all they bring best-fit
   again, finishes the nearly full bins and sends the rest on, up to one root, which finishes every bin.

Pieces of equal length are interchangeable, so what goes up is counts by length: a task gets at most eight times
``capacity`` numbers, whatever the input and however uneven it is, and no bin is left out for that. Pieces are numbered within
their task and length; a task of the tree lays whole ranges of numbers into runs of bins. At the end each piece looks up
the range that has its number.

A document is its token ids and one end token. Null text counts as empty: one piece that holds only the
end. Only documents longer than a sequence are cut; their first piece takes the remainder, all others
are full. Repeated rows are packed each for itself. An empty table gives an empty result. Only
identifier and text are read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import Workspace

CAPACITY = 2048
FAN_IN = 8
# How full a bin must be to be finished before the root.
NEARLY_FULL = 0.98
# Text in which the two tokenizer libraries cannot differ: no special-token strings, and letters whose
# classes are the same in every version of Unicode.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-ɏ‐-‧]*")
SPECIAL = re.compile(r"<\|[a-z]+\|>")
# Fixed value: the split pattern that belongs to the vocabulary's merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def rank_encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str, tokenizer_path: str, ranks_path: str | None) -> np.ndarray:
    """Token ids of a text, as ``tokenizers`` gives them.

    The same vocabulary as ranks gives the same ids several times faster for plain text; with
    ``ranks_path`` it is used there, and ``tokenizers`` for all other texts.
    """
    if ranks_path and PLAIN.fullmatch(text) and not SPECIAL.search(text):
        return rank_encoding(ranks_path).encode_to_numpy(text).astype("<u4", copy=False)
    ids = tokenizer(tokenizer_path).encode(text, add_special_tokens=False).ids
    return np.array(ids, "<u4")


def pieces_of(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece."""
    first = length % capacity
    bounds = ([0] if first else []) + list(range(first, length, capacity))
    return [(start, (first if first and start == 0 else capacity)) for start in bounds]


class Bins:
    """Open bins of one task by free space; ``place`` gives the fullest one that has room."""

    def __init__(self, capacity: int):
        self.capacity, self.fills = capacity, []
        self.by_free: dict[int, list[int]] = defaultdict(list)
        self.free_sizes = 0  # bit f is set when a bin with f free places is open

    def place(self, length: int) -> tuple[int, int]:
        roomy = self.free_sizes >> length
        if roomy:
            free = length + (roomy & -roomy).bit_length() - 1
            number = self.by_free[free].pop()
            if not self.by_free[free]:
                self.free_sizes ^= 1 << free
        else:
            free, number = self.capacity, len(self.fills)
            self.fills.append(0)
        offset = self.fills[number]
        self.fills[number] += length
        if free > length:
            self.by_free[free - length].append(number)
            self.free_sizes |= 1 << (free - length)
        return number, offset


def packed_partition(
    batches: Iterator[pd.DataFrame], capacity: int, fan_in: int, tokenizer_path: str, ranks_path: str | None
) -> Iterator[pd.DataFrame]:
    """Tokenise and pack what one task has. Only a few numbers per piece stay in memory."""
    ids, rows = [], []
    for batch in batches:
        for identifier, text in zip(batch["id"], batch["text"]):
            tokens = np.append(encode(text or "", tokenizer_path, ranks_path), np.uint32(0))
            for number, (start, length) in enumerate(pieces_of(len(tokens), capacity)):
                ids.append(identifier)
                rows.append((number, start, length, zlib.crc32(tokens[start : start + length].astype("<u4").tobytes())))
    if not rows:
        return
    numbers = np.array(rows, np.int64)
    bins, own = Bins(capacity), TaskContext.get().partitionId()
    place = np.zeros((len(rows), 2), np.int64)
    for row in np.argsort(-numbers[:, 2], kind="stable"):
        place[row] = bins.place(int(numbers[row, 2]))
    finished = np.array(bins.fills)[place[:, 0]] >= NEARLY_FULL * capacity
    # pieces of other bins are numbered within their length
    left = np.flatnonzero(~finished)
    order = left[np.argsort(numbers[left, 2], kind="stable")]
    starts = np.flatnonzero(np.diff(numbers[order, 2], prepend=-1))
    number = np.zeros(len(rows), np.int64)
    number[order] = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    frame = pd.DataFrame({
        "id": pd.Series(ids, dtype="object"), "piece": numbers[:, 0].astype(np.int32), "start": numbers[:, 1],
        "length": numbers[:, 2], "crc": numbers[:, 3], "task": np.full(len(rows), own, np.int64), "finished": finished,
        "sequence": np.where(finished, sequence_number(0, own, 0) + place[:, 0], 0), "offset": np.where(finished, place[:, 1], 0),
        "number": number,
    })
    for start in range(0, len(frame), 20_000):
        yield frame.iloc[start : start + 20_000]


def sequence_number(level: int, task: int, place: int) -> int:
    return (level << 58) + (task << 36) + place


def packed_counts(counts: dict[int, int], capacity: int, root: bool) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit, longest first, of so many pieces of each length. Gives the runs laid into finished bins (length, first
    number, pieces, first bin, offset; piece k of a run lies in the k-th bin), and how many bins that are.

    Equal bins are kept as groups: how many, and the runs they hold. Bins are numbered when all are packed.
    """
    groups: dict[int, list[tuple[int, tuple]]] = defaultdict(list)  # by free space
    free_sizes = 0
    for length in sorted(counts, reverse=True):
        todo = counts[length]
        while todo:
            roomy = free_sizes >> length
            if roomy:
                free = length + (roomy & -roomy).bit_length() - 1
                n, content = groups[free].pop()
                taken, each = min(n, todo), 1
                if n > taken:
                    groups[free].append((n - taken, content))
            else:
                # as many new bins as are filled by pieces of this length alone; the last one may get fewer
                free, content, each = capacity, (), min(todo, capacity // length)
                taken = todo // each
            todo -= taken * each
            if free in groups and not groups[free]:
                del groups[free]
                free_sizes &= ~(1 << free)
            rest = free - length * each
            groups[rest].append((taken, content + (length,) * each))
            free_sizes |= 1 << rest
    runs, bins, used = [], 0, defaultdict(int)
    for free in sorted(groups):
        if not root and capacity - free < NEARLY_FULL * capacity:
            break
        for n, content in groups[free]:
            offset = 0
            for length in content:
                runs.append((length, used[length], n, bins, offset))
                used[length] += n
                offset += length
            bins += n
    return runs, bins


RUNS = "kind string, task long, child long, length long, first long, n long, sequence long, offset long"


def merged_group(items: pd.DataFrame, capacity: int, fan_in: int, root: bool, level: int) -> pd.DataFrame:
    """One best-fit round over what neighbouring tasks bring: rows of task, length and n.

    ``child`` rows say from which number on a child's pieces of a length are counted here (``first``), ``run`` rows what
    is laid where, ``rest`` rows how many pieces go on, after those from 0 to ``first`` were laid.
    """
    task, rows = int(items["task"].iloc[0] // fan_in), []
    counts: dict[int, int] = defaultdict(int)
    for child, length, n in sorted(zip(items["task"].tolist(), items["length"].tolist(), items["n"].tolist())):
        rows.append(("child", task, child, length, counts[length], n, 0, 0))
        counts[length] += n
    used: dict[int, int] = defaultdict(int)
    for length, first, n, place, offset in packed_counts(counts, capacity, root)[0]:
        rows.append(("run", task, 0, length, first, n, sequence_number(level, task, place), offset))
        used[length] += n
    rows += [("rest", task, 0, length, used[length], n - used[length], 0, 0) for length, n in counts.items()]
    return pd.DataFrame(rows, columns=[field.split()[0] for field in RUNS.split(", ")])


def merging(capacity: int, fan_in: int, root: bool, level: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def merge(group: pd.DataFrame) -> pd.DataFrame:
        return merged_group(group, capacity, fan_in, root, level)

    return merge


def pack(
    docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, capacity: int = CAPACITY, fan_in: int = FAN_IN,
    id_column: str = "doc_id", text_column: str = "text", more: tuple[str, ...] = (),
) -> DataFrame:
    """One row per piece: id, piece, start, length, crc, sequence, offset."""
    work = Workspace(docs.sparkSession, "packing")
    kind = docs.schema[id_column].dataType.simpleString()

    def leaf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return packed_partition(batches, capacity, fan_in, tokenizer_path, ranks_path)

    # identifiers travel as text, so that a missing one stays missing
    source = docs.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("text"))
    schema = (
        "id string, piece int, start long, length long, crc long, task long, finished boolean, sequence long, offset long, number long"
    )
    pieces = work.keep(source.mapInPandas(leaf, schema), "pieces")
    left = pieces.where("NOT finished")
    items = left.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    top = pieces.agg(F.max("task")).first()[0] or 0
    # of a partition's pieces of a length: how many, from which number on they are still to be laid, the tree's task they
    # have reached, and what is added to their numbers there
    none = F.lit(0).cast("long")
    reached = items.select(F.col("task").alias("leaf"), "length", F.col("n").alias("held"), none.alias("since"), "task", none.alias("shift"))
    laid, root, level = None, False, 0
    while not root:
        root, level = top < fan_in, level + 1
        merged = items.groupBy((F.col("task") / fan_in).cast("long")).applyInPandas(merging(capacity, fan_in, root, level), RUNS)
        merged = work.keep(merged, "level")
        child = merged.where("kind = 'child'").select(F.col("child").alias("task"), "length", F.col("task").alias("parent"), "first")
        reached = reached.join(child, ["task", "length"]).select(
            "leaf", "length", "held", "since", F.col("parent").alias("task"), (F.col("shift") + F.col("first")).alias("shift")
        )
        reached = work.keep(reached, "reached")
        runs = merged.where("kind = 'run'").select("task", "length", "first", "n", "sequence", "offset")
        # the part of each run that a partition's own numbers fall into
        low = F.greatest(F.col("since"), F.col("first") - F.col("shift"))
        high = F.least(F.col("held"), F.col("first") + F.col("n") - F.col("shift"))
        here = reached.join(runs, ["task", "length"]).where(low < high).select(
            "leaf", "length", low.alias("low"), high.alias("high"),
            (F.col("sequence") + F.col("shift") - F.col("first")).alias("sequence"), "offset",
        )
        laid = here if laid is None else laid.union(here)
        rest = merged.where("kind = 'rest'")
        items = rest.where("n > 0").select("task", "length", "n")
        reached = reached.join(rest.select("task", "length", F.col("first").alias("used")), ["task", "length"]).select(
            "leaf", "length", "held", F.greatest(F.col("since"), F.col("used") - F.col("shift")).alias("since"), "task",
            (F.col("shift") - F.col("used")).alias("shift"),
        )
        top //= fan_in
    laid = work.keep(laid, "laid").select(F.col("leaf").alias("task"), "length", "low", "high", F.col("sequence").alias("base"), F.col("offset").alias("at"))
    inside = (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high"))
    placed = left.join(laid, ["task", "length"]).where(inside).select(
        "id", "piece", "start", "length", "crc", (F.col("base") + F.col("number")).alias("sequence"), F.col("at").alias("offset")
    )
    done = pieces.where("finished").select("id", "piece", "start", "length", "crc", "sequence", "offset")
    return done.union(placed).withColumn("id", F.col("id").cast(kind))
