"""Ranked lexical search: the best documents of every item, by branch and bound over document FP-trees.

Of a document only the terms matter that occur in an item. Ordered by falling document frequency, they are a
path, and documents with the same first terms share the path's beginning: an FP-tree. Each node knows the
largest frequency of every term and the least length factor m among the documents below it. A term's part
of the score grows with its frequency and falls with m, so these bound the score of all documents below,
and an item descends, depth first, only where the bound can still reach its current last place.

A task holds one tree at a time, of at most ``BLOCK`` documents, and keeps what each item has found from one
tree to the next. So every task returns at most ``top`` documents per item, and the best of those are the answer.
Items are searched for in blocks of bounded bytes, each against all documents.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qualitymart.llm.common import only_last, small_batches, stored
from qualitymart.llm.token_counts import texts_of

#: Documents of a tree, and different vectors in a leaf.
BLOCK, LEAF = 4096, 4
#: Entries of a tree's vectors; a block ends there too.
ENTRIES = 1_000_000
#: Bytes of item texts that are searched for at once.
ITEM_BYTES = 16 << 20
#: Inner nodes above one another by which a split is by halves.
DEEP = 300
#: Groups in which the tasks' results are cut down first.
FAN_IN = 64

#: All ASCII characters but digits and letters part terms; A-Z become a-z; other characters stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n: int, n_docs: int, n_terms: int) -> int:
    """``n_terms`` are the terms of all ``n_docs`` documents, ``n`` those of this one."""
    return 50 + 50 * n * n_docs // n_terms


def score(tfs: dict[int, int], m: int, terms: list[tuple[int, int, int]], least: int = 0) -> int:
    """The score of an item (``term, weight, rest`` with falling weights; ``rest`` bounds what this and later terms can
    give) for frequencies and a length factor; -1 once it can't reach ``least``."""
    total = 0
    for term, w, rest in terms:
        if total + rest < least:
            return -1
        tf = tfs.get(term)
        if tf:
            total += w * (1_000_000_000 * tf // (1000 * tf + 20 * m))
    return total


def merge_maxima(parts: list[dict[int, int]]) -> dict[int, int]:
    out = dict(max(parts, key=len))
    for part in parts:
        for term, tf in part.items():
            if out.get(term, 0) < tf:
                out[term] = tf
    return out


class Node:
    """Largest frequencies and least m of the documents below; inner nodes have children, leaves vectors
    (``frequencies, m, ids``)."""

    __slots__ = ("children", "least_m", "maxima", "vectors")

    def __init__(self, children: list[Node], vectors: list[tuple]):
        self.children, self.vectors = children, vectors
        self.maxima = merge_maxima([c.maxima for c in children] or [v[0] for v in vectors])
        self.least_m = min([c.least_m for c in children] or [v[1] for v in vectors])


def tree_of(paths: list[tuple[tuple[int, ...], tuple]], depth: int = 0) -> Node:
    """The FP-tree of sorted ``(terms, vector)``; a stretch of a path without a branch has no nodes of its own."""
    if len(paths) <= LEAF:
        return Node([], [vector for _, vector in paths])
    first, last = paths[0][0], paths[-1][0]
    same = 0
    while same < len(first) and same < len(last) and first[same] == last[same]:
        same += 1
    if depth >= DEEP or first == last:
        cuts = [0, len(paths) // 2]
    else:
        branch = [path[same] if len(path) > same else -1 for path, _ in paths]
        cuts = [k for k in range(len(paths)) if k == 0 or branch[k] != branch[k - 1]]
    parts = [paths[a:b] for a, b in zip(cuts, [*cuts[1:], len(paths)], strict=True)]
    if len(parts) > LEAF:  # branches with few documents share a leaf
        merged: list[list] = [[]]
        for part in parts:
            if merged[-1] and len(merged[-1]) + len(part) > LEAF:
                merged.append([])
            merged[-1] += part
        parts = merged
    return Node([tree_of(part, depth + 1) for part in parts], [])


def descend(root: Node, terms: list[tuple[int, int, int]], best: list[tuple], top: int) -> None:
    """Put the tree's documents that belong to the ``top`` best into the heap ``best`` (``score, order, id``, the last
    place first)."""
    stack = [root]
    while stack:
        node = stack.pop()
        least = best[0][0] if len(best) == top else 1
        if score(node.maxima, node.least_m, terms, least) < least:
            continue
        stack += reversed(node.children)
        for tfs, m, ids in node.vectors:
            least = best[0][0] if len(best) == top else 1
            value = score(tfs, m, terms, least)
            if value < least:
                continue
            for order, doc_id in ids:  # from the first place on
                if len(best) < top:
                    heapq.heappush(best, (value, order, doc_id))
                elif (value, order) > best[0][:2]:
                    heapq.heapreplace(best, (value, order, doc_id))
                else:
                    break


def vectors_of(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every document with a term: all its terms counted, those of the vocabulary with
    their frequencies."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            keep, n, terms, tfs = [], [], [], []
            for k, text in texts_of(batch, 1):
                found = terms_of(text)
                if found:
                    held = Counter(filter(None, map(known.get, found)))
                    keep.append(k)
                    n.append(len(found))
                    terms.append(list(held))
                    tfs.append(list(held.values()))
            out = [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))]
            yield pa.record_batch(out, ["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(measure, "doc_id long, n long, terms array<int>, tfs array<int>")


def search_block(docs: DataFrame, items: list[tuple[int, set[bytes]]], top: int) -> DataFrame:
    """``item, rank, doc_id, score`` for items with their terms; ``docs`` has ``_id, _text``."""
    vocabulary = {term: k for k, term in enumerate(sorted(set().union(*(terms for _, terms in items))), 1)}
    vectors = stored(vectors_of(docs, vocabulary), "term-vectors")
    total = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    n_docs, n_terms = total[0], total[1] or 0
    frequencies = vectors.select(F.explode("terms").alias("term")).groupBy("term").count()
    df = {r[0]: r[1] for r in frequencies.toLocalIterator()}  # as many rows as items have terms
    order = {term: place for place, term in enumerate(sorted(df, key=lambda t: (-df[t], t)))}

    wanted = []
    for item, terms in items:
        weights = sorted(((weight(n_docs, df[t]), order[t]) for t in map(vocabulary.__getitem__, terms) if t in df), reverse=True)
        weights = [(w, t) for w, t in weights if w > 0]
        rests = [1_000_000 * sum(w for w, _ in weights[k:]) for k in range(len(weights))]
        wanted.append((item, [(t, w, rest) for (w, t), rest in zip(weights, rests, strict=True)]))
    sent = docs.sparkSession.sparkContext.broadcast((wanted, order))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, order = sent.value
        best: list[list[tuple]] = [[] for _ in wanted]
        held: dict[tuple, list] = {}
        n_held = entries = 0

        def searched() -> None:
            paths = [(path, (dict(zip(path, tfs, strict=True)), m, sorted(ids, reverse=True)[:top])) for (path, tfs, m), ids in held.items()]
            root = tree_of(sorted(paths, key=lambda p: p[0]))
            for (_, terms), found in zip(wanted, best, strict=True):
                if terms:
                    descend(root, terms, found, top)
            held.clear()

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                for doc_id, n, terms, tfs in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    ranked = sorted(zip(map(order.__getitem__, terms), tfs, strict=True))
                    if not ranked:
                        continue
                    key = (*zip(*ranked, strict=True), length_factor(n, n_docs, n_terms))
                    # ascending ids, null last, come first among equals
                    held.setdefault(key, []).append(((doc_id is not None, -(doc_id or 0)), doc_id))
                    n_held, entries = n_held + 1, entries + len(ranked)
                    if n_held >= BLOCK or entries >= ENTRIES:
                        searched()
                        n_held = entries = 0
        if held:
            searched()
        rows = [(item, doc_id, value) for (item, _), found in zip(wanted, best, strict=True) for value, _, doc_id in found]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])

    found = vectors.mapInArrow(search, "item long, doc_id long, score long")
    found = found.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(FAN_IN)))
    best_first = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for group in (["item", "_part"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*best_first))).where(F.col("rank") <= top)
    return found.select("item", "rank", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, top: int = 50, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of every item with a score above 0, the highest first,
    equal scores by ascending id.

    A null, empty or termless text is no document and no item. Rows that repeat a document id are documents of their
    own, and take a place each. A null document id comes after others of its score. Rows that repeat an item id (null
    included) are one item with the terms of all. Empty tables give no rows. No other columns are read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.coalesce(text_column, F.lit("")).alias("_text"))
    asked = items.select(F.col(item_column).cast("long").alias("_item"), F.col(item_text).alias("_text")).where("_text is not null")
    volume = asked.agg(F.sum(F.octet_length("_text") + 16)).first()[0] or 0
    blocks = -(-volume // ITEM_BYTES)
    found = []
    for block in range(blocks):
        texts = asked.where(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == block)
        terms: dict[int | None, set[bytes]] = {}
        for item, text in texts.toLocalIterator():
            terms.setdefault(item, set()).update(terms_of(text))
        names = list(terms)
        table = spark.createDataFrame(list(enumerate(names)), "_n long, item_id long")
        best = only_last(spark, lambda of=[(k, terms[name]) for k, name in enumerate(names)]: stored(search_block(rows, of, top), "best"))
        found.append(best.join(table, best["item"] == table["_n"]).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)
