"""Near duplicates by a MinHash LSH forest: prefix tries, shortened prefixes, exact verification.

A text is the set of its five-word shingles (fewer words, one shingle). Its signature has ``trees`` parts
of ``depth`` minimum hashes. Two texts of similarity s share the first d hashes of a part with
probability s^d.

1. Rows of the same words in the same order are one *node*; only nodes are compared.
2. Nodes that share the shortest useful prefix with no other node have no partner and leave. That prefix is
   the longest one for which 1 - (1 - s^d)^trees still reaches the target recall at the threshold.
3. Prefixes are matched from the longest to that shortest one. All nodes below one trie node (one shared
   prefix in one tree) are compared with a hub chosen among them, so a trie node gives as many pairs as it
   has members, however many share it. In the first turns a node is compared with one of its hubs, not
   with one per tree. Verified links join the labels of hub and member, and members of one label are not compared again.
4. Trie nodes that still hold different labels at the shortest prefix are compared exhaustively, in blocks:
   each task gets two blocks of members and returns links alone. Nothing is capped.
5. Connected components of all links are the classes. Inside each class all pairs of nodes are counted
   exactly, again in blocks, so ``n_links`` is the number of other rows at or above the threshold.

Similarity is the Jaccard index of the shingle sets, taken from whole texts (shingles as 64-bit hashes).

Null, empty and blank texts have no shingles: each such row is a class of its own without links. Texts of one
to four words are linked to equal ones only. Rows without identifier take part; ``class_id`` is the smallest
identifier of the class (null if it has none). Of the rows of a class the one with the smallest identifier is
``first`` (ties: any one of them). An empty table gives an empty result. Only identifier and text are read,
so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import Workspace, free_name
from goldleaf.llm.words import mix, shingles

TREES, DEPTH = 24, 8
RECALL = 0.9999
SIMILARITY = 0.8
BLOCK = 256
# Turns in which each node is compared with one hub only; what they leave apart is compared with all its hubs.
ONE_EACH = 2


def shortest_prefix(trees: int, depth: int, similarity: float, recall: float) -> int:
    """The longest prefix that reaches the recall at the threshold (one hash, if none does)."""
    for d in range(depth, 1, -1):
        if 1 - (1 - similarity**d) ** trees >= recall:
            return d
    return 1


@lru_cache(maxsize=4)
def _family(size: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * size + 1, dtype=np.uint64))
    return (seeds[:size] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seeds[size:] >> np.uint64(32)).astype(np.uint32)


def signature(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each of ``size`` hash functions over a shingle set."""
    factors, shifts = _family(size)
    short = (values >> np.uint64(32)).astype(np.uint32)
    least = np.full(size, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(short), 2048):
        part = short[None, start : start + 2048] * factors[:, None] + shifts[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


def sketch(text: Column, size: int) -> Column:
    """words: digest of the words in order; signature: the minimum hashes. Null for texts without words."""

    @F.pandas_udf("words binary, signature binary")
    def sketched(texts: pd.Series) -> pd.DataFrame:
        keys, signatures = [], []
        for text in texts:
            values = shingles(text)
            blank = len(values) == 0
            joined = b" ".join((text or "").encode("utf-8", "surrogatepass").split())
            keys.append(None if blank else hashlib.blake2b(joined, digest_size=16).digest())
            signatures.append(None if blank else signature(values, size).astype("<u4").tobytes())
        return pd.DataFrame({"words": pd.Series(keys, dtype="object"), "signature": pd.Series(signatures, dtype="object")})

    return sketched(text)


def enough(common: np.ndarray | int, union: np.ndarray | int, similarity: float):
    """common / union >= similarity, in whole numbers."""
    return common * 10_000 >= round(similarity * 10_000) * union


def similar(a: Column, b: Column, similarity: float) -> Column:
    @F.pandas_udf("boolean")
    def verified(left: pd.Series, right: pd.Series) -> pd.Series:
        known = lru_cache(maxsize=64)(shingles)
        found = []
        for x, y in zip(left, right):
            one, other = known(x), known(y)
            common = len(np.intersect1d(one, other, assume_unique=True))
            found.append(bool(enough(common, len(one) + len(other) - common, similarity)))
        return pd.Series(found, dtype="bool")

    return verified(a, b)


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two of the sets share."""
    n = len(sets)
    rows = np.repeat(np.arange(n), [len(one) for one in sets])
    _, columns, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[columns] > 1
    rows, columns = rows[shared], columns[shared]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    _, columns = np.unique(columns, return_inverse=True)
    total = np.zeros((n, n), np.float64)
    last = int(columns[-1]) + 1 if len(columns) else 0
    for start in range(0, last, 4096):
        low, high = np.searchsorted(columns, [start, start + 4096])
        part = np.zeros((n, min(4096, last - start)), np.float32)
        part[rows[low:high], columns[low:high] - start] = 1
        total += part @ part.T
    np.fill_diagonal(total, [len(one) for one in sets])
    return total.astype(np.int64)


def linked_pairs(block: pd.DataFrame, similarity: float) -> tuple[np.ndarray, np.ndarray, pd.DataFrame]:
    """Places of the linked pairs of one block task: both from one block, or one from each of two."""
    block = block.sort_values("uid").reset_index(drop=True)
    sets = [shingles(text) for text in block["text"]]
    common = common_counts(sets)
    sizes = common.diagonal()
    close = enough(common, sizes[:, None] + sizes[None, :] - common, similarity)
    own = block["block"].to_numpy()
    if (block["i"] != block["j"]).any():
        close &= own[:, None] != own[None, :]
    left, right = np.nonzero(np.triu(close, 1))
    return left, right, block


def block_tasks(members: DataFrame, key: str, size: int) -> DataFrame:
    """Deal the members of each key into blocks of about ``size``, and each member to the tasks (i, j) it is in."""
    counts = members.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("_blocks"))
    dealt = members.join(counts, key).withColumn("block", F.pmod(F.xxhash64("uid"), F.col("_blocks")).cast("int"))
    return (
        dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumns({"i": F.least("block", "_other"), "j": F.greatest("block", "_other")})
        .drop("_blocks", "_other")
    )


def prefixes(nodes: DataFrame, trees: int, depth: int, length: int) -> DataFrame:
    """One row per node and tree: the key of the node's prefix of ``length`` hashes."""
    keys = [F.xxhash64(F.lit(t), F.substring("signature", t * depth * 4 + 1, length * 4)) for t in range(trees)]
    rest = [name for name in nodes.columns if name != "signature"]
    return nodes.select(*rest, F.explode(F.array(*keys)).alias("key"))


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """node, label: the smallest node of each connected component, for all nodes that have links."""
    both = work.keep(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "neighbours"
    )
    labels = work.keep(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label")
    ), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("seen")), "b")
        near = near.groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("seen"))
        lowered = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "seen").alias("label"))
        # a label's own label is never larger: take it, which halves long chains
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = work.keep(
            lowered.join(jump, "label").select("node", "old", F.least("label", "next").alias("label")), "labels"
        )
        work.drop(labels)
        labels = moved
        if moved.where("old <> label").isEmpty():
            return labels.select("node", "label")


def stored_rows(
    docs: DataFrame, columns: list[str], id_column: str, text_column: str, size: int, work: Workspace
) -> DataFrame:
    """uid, id, text, words, signature, and ``columns`` as ``rest``. Row numbers hold because the rows are stored."""
    rest = F.struct(F.lit(None).alias(free_name(docs, "_")), *(F.col(f"`{name}`") for name in columns))
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_column).alias("id"),
        F.col(text_column).alias("text"), rest.alias("rest"), sketch(F.col(text_column), size).alias("s"),
    )
    return work.keep(rows.select("uid", "id", "text", "rest", "s.*"), "rows")


def hub_pairs(matched: DataFrame, turn: int, one_each: bool) -> DataFrame:
    """a, of, b, label: each member b of a trie node beside the hub a chosen among its members, where their labels differ.

    A member is below up to one trie node per tree, and has as many hubs. With ``one_each`` it gets only that hub among
    them that comes first in the order hubs are chosen by, so a group gives as many pairs as it has members.
    """
    # another member is the hub each turn; minimum of a hash is a choice that spreads over tasks
    pick = F.struct(F.xxhash64(F.lit(turn), F.col("uid")).alias("_"), F.col("uid").alias("a"), F.col("label").alias("of"))
    hubs = matched.groupBy("key").agg(
        F.min(pick).alias("hub"), F.min("label").alias("low"), F.max("label").alias("high")
    ).where("low < high").select("key", "hub")
    pairs = matched.join(hubs, "key").where("label <> hub.of").select("hub", F.col("uid").alias("b"), "label")
    pairs = pairs.groupBy("b", "label").agg(F.min("hub").alias("hub")) if one_each else pairs.distinct()
    return pairs.select("hub.a", "hub.of", "b", "label")


def joined_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after each hub's label and those linked to it have become the smallest of them.

    All nodes of an old label move, so equal labels always mean a chain of links.
    """
    edges = links.select("of", "label").distinct()
    lowest = edges.groupBy("of").agg(F.min("label").alias("low")).select("of", F.least("of", "low").alias("new"))
    moved = edges.join(lowest, "of").select(F.explode(F.array("of", "label")).alias("label"), "new")
    moved = moved.groupBy("label").agg(F.min("new").alias("new"))
    return labels.join(moved, "label", "left").select("uid", F.coalesce("new", "label").alias("label"))


def links_inside(firsts: DataFrame, classes: DataFrame, texts: DataFrame, similarity: float, block: int) -> DataFrame:
    """uid and how many rows of its class it is linked with, not counting its own copies: all pairs, in blocks."""
    sized = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("label")
    members = classes.join(sized, "label").join(firsts.select("uid", "copies"), "uid")

    def counted(group: pd.DataFrame) -> pd.DataFrame:
        left, right, group = linked_pairs(group, similarity)
        copies = group["copies"].to_numpy()
        links = np.bincount(left, copies[right], len(group)) + np.bincount(right, copies[left], len(group))
        return pd.DataFrame({"uid": group["uid"], "links": links.astype(np.int64)})

    in_blocks = block_tasks(members, "label", block).join(texts, "uid")
    counts = in_blocks.groupBy("label", "i", "j").applyInPandas(counted, "uid long, links long")
    return counts.groupBy("uid").agg(F.sum("links").alias("links"))


def near_classes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: float = SIMILARITY,
    trees: int = TREES, depth: int = DEPTH, recall: float = RECALL, block: int = BLOCK,
) -> DataFrame:
    """One row per input row: uid, id, class_id, n_links, class_size, first."""
    work = Workspace(docs.sparkSession, "lsh-forest")
    rows = stored_rows(docs, [], id_column, text_column, trees * depth, work)
    return classes_of(rows, work, similarity, trees, depth, recall, block)


def classes_of(
    rows: DataFrame, work: Workspace, similarity: float = SIMILARITY, trees: int = TREES, depth: int = DEPTH,
    recall: float = RECALL, block: int = BLOCK, count_links: bool = True,
) -> DataFrame:
    """Without ``count_links`` the links inside classes are left uncounted, and ``n_links`` is null."""
    firsts = work.keep(
        rows.where("words IS NOT NULL").groupBy("words").agg(F.min("uid").alias("uid"), F.count(F.lit(1)).alias("copies")),
        "firsts",
    )
    shortest = shortest_prefix(trees, depth, similarity, recall)
    tree_rows = prefixes(rows.join(firsts.select("uid"), "uid").select("uid", "signature"), trees, depth, shortest)
    tree_rows = work.keep(tree_rows, "prefixes")
    shared = tree_rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    partnered = work.keep(tree_rows.join(shared, "key").select("uid").distinct(), "partnered")
    work.drop(tree_rows)
    nodes = work.keep(rows.join(partnered.hint("merge"), "uid").select("uid", "text", "signature"), "nodes")
    texts = nodes.select("uid", "text")
    labels = nodes.select("uid", F.col("uid").alias("label"))
    found: list[DataFrame] = []

    def verified(pairs: DataFrame) -> DataFrame:
        left = texts.select(F.col("uid").alias("a"), F.col("text").alias("text_a"))
        right = texts.select(F.col("uid").alias("b"), F.col("text").alias("text_b"))
        joined = pairs.join(left, "a").join(right, "b")
        return work.keep(joined.where(similar(F.col("text_a"), F.col("text_b"), similarity)).select("a", "of", "b", "label"), "links")

    def labelled() -> DataFrame:
        return nodes.select("uid", "signature").join(labels, "uid")

    turns = [(depth, 0), (depth, 1)] if depth > shortest else []
    turns += [(length, 2) for length in range(depth - 1, shortest, -2)] + [(shortest, turn) for turn in (3, 4, 5)]
    for place, (length, turn) in enumerate(turns):
        pairs = hub_pairs(prefixes(labelled(), trees, depth, length), turn, one_each=place < ONE_EACH)
        links = verified(pairs)
        found.append(links.select("a", "b"))
        labels = work.keep(joined_labels(labels, links), "labels")

    # classes so far, then what still shares a shortest prefix under different labels
    so_far = found[0]
    for links in found[1:]:
        so_far = so_far.union(links)
    joined = components(so_far, work)
    labels = nodes.select("uid").join(joined.withColumnRenamed("node", "uid"), "uid", "left").select(
        "uid", F.coalesce("label", "uid").alias("label")
    )
    labels = work.keep(labels, "labels")
    matched = prefixes(labelled(), trees, depth, shortest)
    mixed = matched.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    mixed = work.keep(matched.join(mixed.select("key"), "key").select("key", "uid", "label"), "mixed")
    tasks = block_tasks(mixed, "key", block)
    # a task whose members all have one label has nothing to find
    open_tasks = tasks.groupBy("key", "i", "j").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_tasks = open_tasks.where("low < high").select("key", "i", "j")

    def residual(group: pd.DataFrame) -> pd.DataFrame:
        left, right, group = linked_pairs(group, similarity)
        uid, label = group["uid"].to_numpy(), group["label"].to_numpy()
        apart = label[left] != label[right]
        return pd.DataFrame({"a": uid[left[apart]], "b": uid[right[apart]]})

    last = tasks.join(open_tasks, ["key", "i", "j"]).join(texts, "uid")
    last = work.keep(last.groupBy("key", "i", "j").applyInPandas(residual, "a long, b long"), "links")
    if last.isEmpty():
        classes = labels
    else:
        merged = components(
            last.join(labels.select(F.col("uid").alias("a"), F.col("label").alias("x")), "a")
            .join(labels.select(F.col("uid").alias("b"), F.col("label").alias("y")), "b")
            .select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
            work,
        )
        merged = merged.select(F.col("node").alias("label"), F.col("label").alias("to"))
        classes = labels.join(merged, "label", "left").select("uid", F.coalesce("to", "label").alias("label"))
        classes = work.keep(classes, "classes")

    if count_links:
        counts = links_inside(firsts, classes, texts, similarity, block)
        links = F.coalesce(F.col("links"), F.lit(0)) + F.col("copies") - 1
    else:
        counts, links = firsts.select("uid"), F.lit(None).cast("long")
    node_facts = firsts.join(classes, "uid", "left").join(counts, "uid", "left").select(
        "words", F.coalesce("label", "uid").alias("label"),
        links.alias("n_links"),
    )
    node_facts = work.keep(node_facts, "facts")
    placed = rows.select("uid", "id", "words").join(node_facts, "words", "left").select(
        "uid", "id", F.coalesce("label", "uid").alias("label"), (F.coalesce("n_links", F.lit(0)) if count_links else F.col("n_links")).alias("n_links")
    )
    order = F.struct(F.col("id").isNull().alias("unnamed"), F.col("id").alias("id"), F.col("uid").alias("uid"))
    heads = placed.groupBy("label").agg(F.min(order).alias("head"), F.count(F.lit(1)).alias("class_size"))
    return placed.join(heads, "label").select(
        "uid", "id", F.col("head.id").alias("class_id"), "n_links", "class_size", (F.col("head.uid") == F.col("uid")).alias("first")
    )


def kept_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each class, with all its columns: the one with the smallest identifier."""
    work = Workspace(docs.sparkSession, "lsh-forest")
    others = [name for name in docs.columns if name != text_column]
    rows = stored_rows(docs, others, id_column, text_column, TREES * DEPTH, work)
    gone = classes_of(rows, work, count_links=False).where(~F.col("first")).select("uid")
    kept = rows.join(gone, "uid", "left_anti")
    return kept.select(*(F.col("text").alias(name) if name == text_column else F.col("rest")[name].alias(name) for name in docs.columns))
