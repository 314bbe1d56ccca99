"""Ranked lexical search: Block-Max MaxScore over an inverted index in document shards.

*Index.* Each task cuts its documents into shards and writes a row per shard and term: the postings (document
number and occurrences) in blocks of 128, each compressed by itself, beside every block's last document, its most
occurrences and its shortest document. One more row per shard has the documents' identifiers and lengths.
Documents are numbered by identifier within their shard.

*Search.* The number of documents, their lengths and the documents of each query term are summed over all shards. The
rows of the query terms meet by shard and block of queries. There each query keeps a heap of its best documents
and goes through the shard in windows of documents. Terms are ordered by the highest score any of their postings can have;
those whose bounds together cannot pass the worst of the heap are not essential. Only essential lists give
candidates. On the other lists block maxima, which need no decompression, reject candidates that cannot enter
the heap; blocks are decompressed for what is left, the strongest list first, rejecting again after
each. The heaps of all shards are merged.

A term is a maximal run of anything but ASCII characters that are no letters or digits; only A-Z is lower-cased. The score of
a document is the sum over the query's terms, once each, of ``w * (10**9 * tf div (1000 * tf + 8 * m))``, where
``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and ``m = 10 + 90 * n * N div L``.

Null and empty texts have no terms: they are indexed and never found, as queries they find nothing. Equal scores go by
ascending identifier, null last. Repeated rows of documents are found each for itself, repeated queries
answered each for itself. Very long texts are taken whole. Empty tables give an empty result. Only identifier and
text are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from goldleaf.llm.common import Workspace

BLOCK = 128
# A shard is closed at so many documents or bytes of text, whichever comes first.
SHARD_DOCS, SHARD_BYTES = 1 << 13, 1 << 24
# Rows of a shard that are handed on at once.
ROWS = 4096
# Bytes of text whose words are held at once.
GROUP_BYTES = 1 << 20
# Queries of one block; each shard meets each block in a group of its own.
QUERIES = 2000
# Query terms up to which the term table is broadcast (some 100 bytes each); beyond, the join shuffles both sides.
BROADCAST_TERMS = 100_000
# Documents of the first window, which fills the heaps, and of the next ones.
FIRST_WINDOW, WINDOW = 256, 2048
INDEX = (
    "shard long, term string, df long, total long, ids array<long>, last array<int>, most array<int>, shortest array<int>, "
    "ends array<int>, postings binary"
)
_KIND = pa.schema(
    [
        ("shard", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("total", pa.int64()), ("ids", pa.list_(pa.int64())),
        ("last", pa.list_(pa.int32())), ("most", pa.list_(pa.int32())), ("shortest", pa.list_(pa.int32())),
        ("ends", pa.list_(pa.int32())), ("postings", pa.binary()),
    ]
)
# What each byte of a text becomes: A-Z small, other ASCII that is no letter or digit a space.
TERM_BYTES = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or 48 <= byte <= 57 or 97 <= byte <= 122 else 32
    for byte in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, in UTF-8."""
    return (text or "").encode("utf-8").translate(TERM_BYTES).split()


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in as few bytes as they need, seven bits a byte, and where each one ends."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for step in range(1, 5):
        sizes += values >= (1 << (7 * step))
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for step in range(5):
        more = np.flatnonzero(sizes > step)
        part = (values[more] >> np.uint64(7 * step)) & np.uint64(127)
        out[ends[more] - sizes[more] + step] = part.astype(np.uint8) | ((sizes[more] > step + 1) << 7).astype(np.uint8)
    return out, ends


def unpack(data: np.ndarray) -> np.ndarray:
    final = np.flatnonzero(data < 128)
    starts = np.concatenate(([0], final[:-1] + 1))
    place = np.arange(len(data)) - np.repeat(starts, final - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts)


class Shard:
    """Postings of one shard while it is filled."""

    def __init__(self) -> None:
        self.codes: dict[bytes, int] = {}
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, ids: Sequence[int | None], texts: Sequence[list[bytes]]) -> None:
        sizes = np.array([len(found) for found in texts], np.int64)
        flat = np.empty(int(sizes.sum()), object)
        flat[:] = [word for found in texts for word in found]
        codes, different = pd.factorize(flat)
        pairs, often = np.unique(codes * len(texts) + np.repeat(np.arange(len(texts)), sizes), return_counts=True)
        known = np.array([self.codes.setdefault(word, len(self.codes)) for word in different], np.int64)
        first = len(self.ids)
        self.parts.append(
            (known[pairs // len(texts)].astype(np.int32), (first + pairs % len(texts)).astype(np.int32), often.astype(np.int32))
        )
        self.ids += ids
        self.lengths += sizes.tolist()

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        lengths = np.array(self.lengths, np.int64)
        order = sorted(range(len(self.ids)), key=lambda place: (self.ids[place] is None, self.ids[place] or 0))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        lengths = lengths[order]
        blank = {"shard": [number], "term": [None], "most": [None], "shortest": [None], "ends": [None], "postings": [None]}
        own = {"df": [int((lengths > 0).sum())], "total": [int(lengths.sum())], "last": [lengths.astype(np.int32)]}
        yield _batch(blank | own | {"ids": [[self.ids[place] for place in order]]})
        if not self.codes:
            return
        code, doc, often = (np.concatenate(part) for part in zip(*self.parts))
        self.parts.clear()
        doc = rank[doc]
        order = np.lexsort((doc, code))
        code, doc, often = code[order], doc[order], often[order].astype(np.int64)
        df = np.bincount(code, minlength=len(self.codes))
        after = np.cumsum(df)
        within = np.arange(len(doc)) - np.repeat(after - df, df)
        starts = np.flatnonzero(within % BLOCK == 0)
        gap = doc - np.concatenate(([-1], doc[:-1])) - 1
        gap[within == 0] = doc[within == 0]
        packed, packed_ends = pack(np.stack((gap, often - 1), axis=1).ravel())
        block_ends = np.append(starts[1:], len(doc))
        blocks = np.concatenate(([0], np.cumsum(-(-df // BLOCK))))
        byte_ends = packed_ends[2 * after - 1]
        byte_starts = np.concatenate(([0], byte_ends[:-1]))
        end_in_term = packed_ends[2 * block_ends - 1] - np.repeat(byte_starts, np.diff(blocks))

        def lists(values: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(blocks, pa.int32()), pa.array(values, pa.int32()))

        n, offsets = len(df), np.concatenate(([0], byte_ends)).astype(np.int32)
        whole = pa.record_batch(
            [
                pa.array(np.full(n, number)), pa.array(list(self.codes), pa.binary()).cast(pa.string()), pa.array(df, pa.int64()),
                pa.array(np.add.reduceat(often, after - df)), pa.nulls(n, pa.list_(pa.int64())), lists(doc[block_ends - 1]),
                lists(np.maximum.reduceat(often, starts)), lists(np.minimum.reduceat(lengths[doc], starts)), lists(end_in_term),
                pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(packed.tobytes())]),
            ],
            schema=_KIND,
        )
        yield from (whole.slice(start, ROWS) for start in range(0, n, ROWS))


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.record_batch([pa.array(columns[field.name], field.type) for field in _KIND], schema=_KIND)


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's postings, as rows of ``INDEX``. Store it before it is searched: shards are numbered by task."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = TaskContext.get().partitionId() << 24, Shard()
        ids, texts, held = [], [], 0
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = value.as_py()
                ids.append(name)
                texts.append(terms(value))
                held += len(value or "")
                full = len(shard.ids) + len(ids) >= SHARD_DOCS or shard.size + held >= SHARD_BYTES
                if held >= GROUP_BYTES or full:
                    shard.add(ids, texts)
                    shard.size += held
                    ids, texts, held = [], [], 0
                if full:
                    yield from shard.rows(number)
                    number, shard = number + 1, Shard()
        if ids:
            shard.add(ids, texts)
        if shard.ids:
            yield from shard.rows(number)

    chosen = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return chosen.mapInArrow(index, INDEX)


class Postings:
    """One term's list in one shard. Blocks are decompressed when they are asked for, once."""

    def __init__(self, weight: int, df: int, last, most, shortest, ends, packed: bytes, norm):
        self.weight, self.norm, self.last, self.ends = weight, norm, last.astype(np.int64), ends
        self.data = np.frombuffer(packed, np.uint8)
        self.bounds = self.points(most.astype(np.int64), norm.of(shortest.astype(np.int64)))
        self.bound = int(self.bounds.max())
        self.known = np.zeros(len(last), bool)
        # a block that is not decompressed yet holds its last document everywhere, which keeps the list in order
        self.docs = np.repeat(self.last, BLOCK)[:df]
        self.scores = np.zeros(df, np.int64)

    def points(self, often: np.ndarray, norm: np.ndarray) -> np.ndarray:
        return self.weight * (1_000_000_000 * often // (1000 * often + 8 * norm))

    def load(self, blocks: np.ndarray) -> None:
        missing = blocks[~self.known[blocks]]
        if not len(missing):
            return
        self.known[missing] = True
        starts = np.where(missing > 0, self.ends[missing - 1], 0)
        data = np.concatenate([self.data[a:b] for a, b in zip(starts.tolist(), self.ends[missing].tolist())])
        gap, often = unpack(data).reshape(-1, 2).T
        sizes = np.minimum(BLOCK, len(self.docs) - missing * BLOCK)
        firsts = np.cumsum(sizes) - sizes
        run = np.cumsum(gap + 1)
        before = np.where(missing > 0, self.last[missing - 1], -1) - (run[firsts] - gap[firsts] - 1)
        docs = run + np.repeat(before, sizes)
        at = np.arange(len(docs)) - np.repeat(firsts - missing * BLOCK, sizes)
        self.docs[at] = docs
        self.scores[at] = self.points(often + 1, self.norm.by_doc[docs])

    def window(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``low`` up to ``high`` and their scores."""
        first, after = np.searchsorted(self.last, (low, high - 1))
        self.load(np.arange(first, min(after + 1, len(self.last))))
        a, b = np.searchsorted(self.docs, (low, high))
        return self.docs[a:b], self.scores[a:b]

    def most(self, docs: np.ndarray) -> np.ndarray:
        """What each document can get at most, from block maxima alone."""
        block = np.searchsorted(self.last, docs)
        return np.where(block < len(self.last), self.bounds[np.minimum(block, len(self.last) - 1)], 0)

    def get(self, docs: np.ndarray) -> np.ndarray:
        """The scores of these documents, 0 where the term is not in one."""
        block = np.searchsorted(self.last, docs)
        self.load(np.unique(block[block < len(self.last)]))
        place = np.minimum(np.searchsorted(self.docs, docs), len(self.docs) - 1)
        return np.where(self.docs[place] == docs, self.scores[place], 0)


class Norm:
    """How document length dampens occurrences."""

    def __init__(self, documents: int, total: int, lengths: np.ndarray):
        self.documents, self.total = documents, max(1, total)
        self.by_doc = self.of(lengths.astype(np.int64))

    def of(self, lengths: np.ndarray) -> np.ndarray:
        return 10 + 90 * lengths * self.documents // self.total


def best(lists: Sequence[Postings], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best documents of a shard and their scores, by falling score and rising number."""
    lists = sorted(lists, key=lambda postings: postings.bound)
    upto = np.cumsum([postings.bound for postings in lists])
    docs, scores, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    low = 0
    while low < n_docs:
        high = min(n_docs, low + (WINDOW if low else FIRST_WINDOW))
        # lists before this one cannot lift a document over the worst of the heap, not even together
        essential = int(np.searchsorted(upto, least, side="right"))
        if essential == len(lists):
            break
        sums = np.zeros(high - low, np.int64)
        for postings in lists[essential:]:
            found, points = postings.window(low, high)
            sums[found - low] += points
        rest = lists[:essential]
        candidates = np.flatnonzero(sums > 0)
        points = sums[candidates]
        if rest and len(candidates):
            hopeful = points + upto[essential - 1] > least
            candidates, points = candidates[hopeful], points[hopeful]
            limits = np.stack([postings.most(candidates + low) for postings in rest])
            # what the lists up to this one can add at most
            limits = np.cumsum(limits, axis=0)
            for place in range(essential - 1, -1, -1):
                hopeful = points + limits[place] > least
                candidates, points, limits = candidates[hopeful], points[hopeful], limits[:, hopeful]
                if not len(candidates):
                    break
                points = points + rest[place].get(candidates + low)
        entering = points > least
        docs, scores = np.append(docs, candidates[entering] + low), np.append(scores, points[entering])
        if len(docs) > k:
            order = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[order], scores[order]
        if len(docs) == k:
            least = int(scores.min())
        low = high
    order = np.lexsort((docs, -scores))
    return docs[order], scores[order]


def search(index: DataFrame, queries: DataFrame, k: int = 10, query_id: str = "item_id", text: str = "text") -> DataFrame:
    """The ``k`` best documents of each query: identifier of the query, ``rank``, ``doc_id`` and ``score`` above 0.

    ``index`` is a stored result of ``build_index``.
    """
    spark = index.sparkSession
    work = Workspace(spark, "block-max")

    @F.arrow_udf("array<string>")
    def different_terms(texts: pa.Array) -> pa.Array:
        return pa.array([[word.decode() for word in sorted(set(terms(value.as_py())))] for value in texts], pa.list_(pa.string()))

    asked = queries.select(
        F.monotonically_increasing_id().alias("query"), F.col(query_id).alias("item"), different_terms(F.col(text)).alias("terms")
    )
    asked = work.keep(asked, "queries")
    blocks = max(1, math.ceil(asked.count() / QUERIES))
    shards = index.where("term is null")
    documents, total = shards.agg(F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()

    wanted = asked.select("query", F.pmod(F.xxhash64("query"), F.lit(blocks)).alias("part"), F.explode("terms").alias("term"))
    by_term = work.keep(wanted.groupBy("part", "term").agg(F.sort_array(F.collect_list("query")).alias("queries")), "terms")
    n_terms = by_term.count()

    def fitting(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if n_terms <= BROADCAST_TERMS else df

    in_use = index.where("term is not null").select("term", "df").join(fitting(by_term.select("term").distinct()), "term")
    everywhere = in_use.groupBy("term").agg(F.sum("df").alias("all"))
    rarity = F.floor(1000 * F.log((2 * F.lit(documents) + 2).cast("double") / (2 * F.col("all") + 1))).cast("long")
    weighted = work.keep(by_term.join(everywhere, "term").select("part", "term", "queries", rarity.alias("weight")), "weights")

    postings = index.where("term is not null").drop("ids", "total").join(fitting(weighted), "term")
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    tables = shards.select("shard", parts.alias("part"), "ids", F.col("last").alias("last"))
    rows = postings.select(
        "shard", "part", "weight", "queries", "df", "last", "most", "shortest", "ends", "postings"
    ).unionByName(tables, allowMissingColumns=True)
    found = rows.groupBy("shard", "part").applyInArrow(_searcher(documents, total, k), "query long, doc_id long, score long")
    order = W.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    merged = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return merged.join(asked.select("query", F.col("item").alias(query_id)), "query").select(
        query_id, F.col("rank").cast("int").alias("rank"), "doc_id", "score"
    )


def _searcher(documents: int, total: int, k: int):
    """The search of one shard for one block of queries."""

    def searched(rows: pa.Table) -> pa.Table:
        kinds = [("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]
        of = {name: rows.column(name).combine_chunks() for name in rows.column_names}
        head = of["weight"].is_null().to_numpy(zero_copy_only=False)
        place = int(np.flatnonzero(head)[0])
        ids, lengths = of["ids"][place].as_py(), np.asarray(of["last"][place].values)
        norm = Norm(documents, total, lengths)
        asked: dict[int, list[Postings]] = {}
        for row in np.flatnonzero(~head).tolist():
            weight = of["weight"][row].as_py()
            if weight <= 0:
                continue
            arrays = (np.asarray(of[name][row].values) for name in ("last", "most", "shortest", "ends"))
            made = Postings(weight, of["df"][row].as_py(), *arrays, of["postings"][row].as_py(), norm)
            for query in of["queries"][row].as_py():
                asked.setdefault(query, []).append(made)
        out: tuple[list, list, list] = ([], [], [])
        for query, lists in asked.items():
            docs, scores = best(lists, len(ids), k)
            out[0].extend([query] * len(docs))
            out[1].extend(ids[doc] for doc in docs.tolist())
            out[2].extend(scores.tolist())
        return pa.table([pa.array(values, kind) for values, (_, kind) in zip(out, kinds)], names=[name for name, _ in kinds])

    return searched
