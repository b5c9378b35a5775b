"""Documents whose sets of word n-grams have a Jaccard similarity over a threshold, as components.

The method is a count-vector R-tree: n-grams are hashed into ``AXES`` groups, a document is the point of its
counts per group, and the overlap of two documents is at most the sum of the coordinates' minima. Boxes
around points bound it the same way, so a tree of boxes finds the points that can reach the threshold;
what it finds is bounded once more with finer groups and verified on the n-grams themselves.

One tree can't hold the corpus, and points of unrelated documents lie so close that no cut of the space
parts them. So the join is first dealt by content: for two documents of a size class, the threshold allows
at most d n-grams that only one of them has, and if n-grams are hashed into more than d groups, at least
one group is the same in both. Each document is sent once per non-empty group, keyed by the group's
content, and only documents that share a key are compared, by the bound above.

A large group of near copies shares most keys. Its pairs aren't all made: first every document is verified
against the smallest id under each of its keys, which already joins such a group. The tree then looks, under
keys that still hold several components, for pairs across them; no link is lost, as two documents of one
component need none. A large key is cut into blocks, and every two blocks that aren't of one component are
compared by themselves, so no task holds more than two.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualitymart.llm.common import batch_rows, numbered, only_last, partitions, small_batches, stored
from qualitymart.llm.components import components
from qualitymart.llm.token_counts import texts_of

#: Groups of the count vectors, and the count from which on a coordinate is only known to be that high.
AXES, FULL = 256, 255
#: Points in a leaf of the tree, and children of an inner node.
LEAF = 16
#: Rows of a key that are compared in one task; a larger key is cut into blocks of about as many.
BLOCK = 2048
#: A table of ids is sent to all tasks if it has at most this many rows (24 MB), else it is joined by a shuffle.
SENT = 1_000_000
#: Words whose hashes a worker remembers.
KNOWN = 1 << 18
#: Sets a task remembers having sent.
SEEN = 100_000
#: Largest size of a class over its smallest.
SPAN = 1.5

U64 = np.uint64


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < KNOWN and len(word) <= 32:
            self[word] = value
        return value


HASHES = WordHashes()


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A second hash of 64-bit hashes."""
    with np.errstate(over="ignore"):
        x = x + U64((0x9E3779B97F4A7C15 * (2 * seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams: A-Z lower-cased, words between ASCII white space, a shorter
    text as one n-gram, none for a text without words."""
    found = text.encode("utf-8", "replace").lower().split()
    if not found:
        return np.zeros(0, U64)
    hashed = np.fromiter(map(HASHES.__getitem__, found), U64, len(found))
    size = min(words, len(found))
    out = np.full(len(found) - size + 1, size, U64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = out * U64(0x9E3779B97F4A7C15) + hashed[k : len(found) - size + 1 + k]
    return np.unique(mixed(out))


def count_vector(found: np.ndarray) -> np.ndarray:
    counts = np.bincount((mixed(found, 1) >> U64(56)).astype(np.int64), minlength=AXES)
    return np.minimum(counts, FULL).astype(np.uint8)


def fine_vector(found: np.ndarray) -> bytes:
    """A count vector with as many groups as the set has n-grams, up to a power of two, compressed. It can be
    folded to fewer groups, as a group of half as many is the sum of two."""
    axes = max(AXES, 1 << max(len(found) - 1, 1).bit_length())
    counts = np.bincount((mixed(found, 1) >> U64(65 - axes.bit_length())).astype(np.int64), minlength=axes)
    return zstandard.compress(counts.astype(np.uint8 if counts.max() < 256 else np.uint32).tobytes() + bytes([int(counts.max() >= 256)]))


def fine_overlap(x: bytes, y: bytes) -> int:
    """The summed minima of two fine vectors, over the groups of the smaller one."""
    vectors = []
    for packed in (x, y):
        raw = zstandard.decompress(packed)
        vectors.append(np.frombuffer(raw[:-1], np.uint32 if raw[-1] else np.uint8).astype(np.uint32))
    axes = min(map(len, vectors))
    small = [v.reshape(axes, -1).sum(1) for v in vectors]
    return int(np.minimum(*small).sum())


def can_link(x: np.ndarray, y: np.ndarray, sizes_x: np.ndarray | int, sizes_y: np.ndarray, threshold: int) -> np.ndarray:
    """Whether the summed minima of count vectors (rows, or one row against all) allow the threshold."""
    least = np.minimum(x, y)
    bound = least.sum(1, dtype=np.int64)
    if least.size and least.max() >= FULL:
        bound[(least >= FULL).any(1)] = np.iinfo(np.int64).max
    return bound >= overlap_needed(sizes_x, sizes_y, threshold)


@lru_cache(maxsize=64)
def size_class(threshold: int, least: int) -> tuple[int, int]:
    """For the size class from ``least`` on: the next class's least size, and the n-grams at most that only
    one document of a pair has if the larger one is of this class."""
    after = max(least + 1, int(least * SPAN))
    return after, int((100 - threshold) * 2 * (after - 1) / (100 + threshold) + 1e-9)


def classes_of(size: int, threshold: int) -> list[tuple[int, int]]:
    """``(least size, differences)`` of a document's own class, and of the next one if a partner can be there."""
    least = 1
    while size_class(threshold, least)[0] <= size:
        least = size_class(threshold, least)[0]
    after, differences = size_class(threshold, least)
    own = [(least, differences)]
    return own + [(after, size_class(threshold, after)[1])] if 100 * size >= threshold * after else own


def group_keys(found: np.ndarray, threshold: int) -> np.ndarray:
    """Hashes of the contents of a document's groups, in each of its classes. Empty groups have keys only
    where a pair could agree in nothing else."""
    keys = []
    for least, differences in classes_of(len(found), threshold):
        groups = differences + differences // 16 + 4 if differences else 1
        group = ((mixed(found, 2) >> U64(32)) * U64(groups)) >> U64(32)
        order = np.argsort(group.astype(np.uint16) if groups <= 1 << 16 else group, kind="stable")
        group = group[order]
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        sums = np.add.reduceat(mixed(found, 3)[order], starts)
        place = group[starts] + U64(least << 24)
        keys.append(mixed(sums + mixed(place, 4), 5))
        if groups - len(starts) >= groups - differences:
            empty = np.setdiff1d(np.arange(groups, dtype=U64), group[starts])
            keys.append(mixed(empty + U64(least << 24), 6))
    return np.concatenate(keys)


def overlap_needed(a: np.ndarray | int, b: np.ndarray | int, threshold: int) -> np.ndarray:
    """The least intersection that two sets of these sizes need."""
    return np.ceil(threshold * (np.asarray(a, np.int64) + b) / (100 + threshold) - 1e-9)


class Tree:
    """An R-tree of count vectors, packed level by level from points sorted by size and by coordinates."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        order = np.lexsort((points[:, 1], points[:, 0], sizes))
        groups = [order[k : k + LEAF] for k in range(0, len(order), LEAF)]
        top, small = np.array([points[g].max(0) for g in groups]), np.array([sizes[g].min() for g in groups])
        self.levels = [(groups, top, small)]
        while len(groups) > 1:
            groups = [np.arange(k, min(k + LEAF, len(top))) for k in range(0, len(top), LEAF)]
            top, small = np.array([top[g].max(0) for g in groups]), np.array([small[g].min() for g in groups])
            self.levels.append((groups, top, small))

    def reach(self, point: np.ndarray, size: int, threshold: int) -> np.ndarray:
        """The points whose overlap with ``point`` may reach the threshold."""
        at = np.zeros(1, int)
        for groups, top, small in reversed(self.levels):
            can = at[can_link(top[at], point, size, small[at], threshold)]
            at = np.concatenate([groups[k] for k in can]) if len(can) else np.zeros(0, int)
        return at[can_link(self.points[at], point, size, self.sizes[at], threshold)]


def keyed(rows: DataFrame, words: int, threshold: int) -> DataFrame:
    """``node, n_shingles, _k1, _k2, vector, fine, keys`` of every row: the size and a 128-bit hash of its set, the
    count vectors and the group keys. A set that the task has seen lately has no keys, and neither has a null node."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        pack = zstandard.ZstdCompressor().compress
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            if len(seen) > SEEN:
                seen.clear()
            valid = batch.column(0).is_valid().to_pylist()
            for k, text in texts_of(batch, 1):
                found = shingles(text, words)
                whole = tuple(int(mixed(found, seed).sum(dtype=U64).view(np.int64)) for seed in (7, 8))
                new = valid[k] and len(found) and whole not in seen
                if valid[k]:
                    seen.add(whole)
                keys = group_keys(found, threshold).view(np.int64) if new else np.zeros(0, np.int64)
                for column, value in zip(columns, (len(found), *whole, pack(count_vector(found).tobytes()), fine_vector(found), keys), strict=True):
                    column.append(value)
            ends = np.cumsum([0, *map(len, columns[5])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *columns[5]])))
            out = [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), *(pa.array(c, pa.binary()) for c in columns[3:5]), lists]
            yield pa.record_batch(out, ["node", "n_shingles", "_k1", "_k2", "vector", "fine", "keys"])

    return rows.mapInArrow(measure, "node long, n_shingles long, _k1 long, _k2 long, vector binary, fine binary, keys array<long>")


def shared_keys(measured: DataFrame) -> DataFrame:
    """``key, node`` of all documents that share a key with another one, and ``leader``, the smallest of them.

    A task reads its keys in order and holds no group.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key = held_node = leader = None  # the last row so far and its run's leader
        for batch in batches:
            keys, nodes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(keys):
                continue
            if held_key is not None:
                keys, nodes = np.concatenate([[held_key], keys]), np.concatenate([[held_node], nodes])
            new = np.concatenate([[True], keys[1:] != keys[:-1]])
            starts, run = np.flatnonzero(new), np.cumsum(new) - 1
            leaders = nodes[starts]
            if leader is not None:
                leaders[0] = leader
            lengths = np.diff(np.append(starts, len(keys)))
            shared = (nodes[starts + lengths - 1] != leaders)[run]
            shared[-1] = False  # the last row waits, as its run may go on in the next batch
            if shared.any():
                yield pa.record_batch([pa.array(keys[shared]), pa.array(nodes[shared]), pa.array(leaders[run][shared])], ["key", "node", "leader"])
            held_key, held_node, leader = keys[-1], nodes[-1], leaders[-1]
        if held_key is not None and leader != held_node:
            yield pa.record_batch([pa.array([held_key]), pa.array([held_node]), pa.array([leader])], ["key", "node", "leader"])

    n = partitions(measured.sparkSession)
    keys = measured.where("node is not null").select(F.explode("keys").alias("key"), "node")
    dealt = keys.repartition(n, "key").sortWithinPartitions("key", "node")
    return dealt.mapInArrow(runs, "key long, node long, leader long")


def sent_if_few(table: DataFrame) -> DataFrame:
    """A stored table of ids, to be sent to all tasks if it has few rows."""
    return F.broadcast(table) if table.limit(SENT + 1).count() <= SENT else table


def semi(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The ``rows`` whose ``column`` is in ``ids`` (one column ``_id``, distinct): sent to all tasks if they are few."""
    ids = sent_if_few(ids)
    return rows.join(ids, rows[column] == ids["_id"], "left_semi")


def verified(pairs: DataFrame, rows: DataFrame, words: int, threshold: int) -> DataFrame:
    """The ``pairs`` (``a, b``) whose n-grams reach the threshold. Only texts of documents in a pair are moved."""
    ids = stored(pairs.select(F.col("a").alias("_id")).unionByName(pairs.select(F.col("b").alias("_id"))).distinct(), "candidates")
    texts = stored(semi(rows, ids, "_node").dropDuplicates(["_node"]), "candidate-texts")
    left = pairs.join(texts.select(F.col("_node").alias("a"), F.col("_text").alias("_left")), "a")
    both = left.join(texts.select(F.col("_node").alias("b"), F.col("_text").alias("_right")), "b").select("a", "b", "_left", "_right")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for (_, x), (_, y) in zip(texts_of(batch, 2), texts_of(batch, 3), strict=True):
                p, q = shingles(x, words), shingles(y, words)
                same = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * same >= threshold * (len(p) + len(q) - same))
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with batch_rows(rows.sparkSession, 200):
        return stored(both.mapInArrow(check, "a long, b long"), "links")


def vectors_of(column: pa.Array) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor().decompress
    return np.frombuffer(b"".join(map(unpack, column.to_pylist())), np.uint8).reshape(-1, AXES)


def bounded(pairs: DataFrame, points: DataFrame, threshold: int) -> DataFrame:
    """The ``pairs`` whose fine count vectors allow the threshold; most others end here, before texts are moved. Only
    vectors of documents in a pair are moved."""
    pairs = stored(pairs, "candidate-pairs")
    ids = stored(pairs.select(F.col("a").alias("_id")).unionByName(pairs.select(F.col("b").alias("_id"))).distinct(), "candidates")
    points = semi(points, ids, "node").dropDuplicates(["node"])
    left = pairs.join(points.select(F.col("node").alias("a"), F.col("n_shingles").alias("_m"), F.col("fine").alias("_left")), "a")
    both = left.join(points.select(F.col("node").alias("b"), F.col("n_shingles").alias("_n"), F.col("fine").alias("_right")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [batch.column(k).to_numpy() for k in (2, 3)]
            overlaps = [fine_overlap(x, y) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)]
            keep = np.array(overlaps, np.int64) >= overlap_needed(*sizes, threshold)
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    with batch_rows(points.sparkSession, 500):
        return stored(both.select("a", "b", "_m", "_n", "_left", "_right").mapInArrow(check, "a long, b long"), "pairs")


def compared(shared: DataFrame, keys: DataFrame) -> DataFrame:
    """``group, side, node, component`` of the rows of ``shared`` (``key, node, component``) under ``keys`` (``key, n``: its rows).

    A key with at most ``BLOCK`` rows is one group, of side -1. A larger one is cut: components that are large in it have
    blocks of their own, the others share some, each by a hash of the node. Every two blocks of a key are one group, of
    sides 0 and 1, and a shared block is also a group by itself, of side -1. Blocks of one component aren't compared.
    """
    large_keys = keys.where(F.col("n") > BLOCK).select("key")
    small = shared.join(keys.where(F.col("n") <= BLOCK), "key").select(F.col("key").alias("group"), F.lit(-1).alias("side"), "node", "component")
    if not large_keys.limit(1).count():
        return small
    large = stored(semi(shared, large_keys.withColumnRenamed("key", "_id"), "key").select("key", "node", "component"), "large-keys")
    sizes = large.groupBy("key", "component").agg(F.count(F.lit(1)).alias("_rows"))
    part = F.when(F.col("_rows") * 4 >= BLOCK, F.col("component"))  # null for the components that share blocks
    parts = stored(sizes.groupBy("key", part.alias("_part")).agg(F.ceil(F.sum("_rows") / BLOCK).alias("_cuts")), "parts")

    own = parts.where("_part is not null").select("key", F.col("_part").alias("component"), F.lit(True).alias("_own"), "_cuts")
    pool = parts.where("_part is null").select("key", F.col("_cuts").alias("_pool"))
    if parts.limit(SENT + 1).count() <= SENT:
        own, pool = F.broadcast(own), F.broadcast(pool)
    rows = large.join(own, ["key", "component"], "left").join(pool, "key", "left")
    salt = F.pmod(F.xxhash64("node"), F.coalesce("_cuts", "_pool"))
    block = F.struct(F.col("_own").isNull().alias("shared"), F.when(F.col("_own"), F.col("component")).otherwise(0).alias("part"), salt.alias("salt"))
    rows = rows.select("key", "node", "component", block.alias("_block"))

    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_cuts") - 1))
    blocks = parts.select("key", "_part", salts.alias("_salt"))
    blocks = blocks.select("key", F.struct(F.col("_part").isNull().alias("shared"), F.coalesce("_part", F.lit(0)).alias("part"), F.col("_salt").alias("salt")).alias("_block"))
    other = blocks.select("key", F.col("_block").alias("_other"))
    pairs = blocks.join(other, "key").where("_block <= _other and (_block.shared or _block.shared <> _other.shared or _block.part <> _other.part)")
    pairs = stored(pairs.withColumn("group", F.xxhash64("key", "_block", "_other")), "block-pairs")
    sides = pairs.select("key", "_block", "group", F.expr("if(_block = _other, -1, 0)").alias("side"))
    sides = sides.unionByName(pairs.where("_block <> _other").select("key", F.col("_other").alias("_block"), "group", F.lit(1).alias("side")))
    return small.unionByName(rows.join(sides, ["key", "_block"]).select("group", "side", "node", "component"))


def across(shared: DataFrame, keys: DataFrame, points: DataFrame, threshold: int) -> DataFrame:
    """Pairs of documents under one of ``keys`` that are in different components: a tree per group of ``compared``, of which
    a group with at most ``LEAF`` documents needs only the leaf."""

    def told(nodes: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(np.minimum(nodes[i], nodes[j])), pa.array(np.maximum(nodes[i], nodes[j]))], ["a", "b"])

    def in_leaves(groups, nodes, sides, parts, sizes, vectors) -> Iterator[pa.RecordBatch]:
        for gap in range(1, min(LEAF, len(groups))):
            apart = (parts[gap:] != parts[:-gap]) & ((sides[gap:] < 0) | (sides[gap:] != sides[:-gap]))
            i = np.flatnonzero((groups[gap:] == groups[:-gap]) & apart)
            if len(i):
                i = i[can_link(vectors[i], vectors[i + gap], sizes[i], sizes[i + gap], threshold)]
                yield told(nodes, i, i + gap)

    def in_tree(nodes, sides, parts, sizes, vectors) -> Iterator[pa.RecordBatch]:
        left, right = np.flatnonzero(sides < 1), np.flatnonzero(sides != 0)
        if len(left) and len(right) and len(np.unique(parts)) > 1:
            tree = Tree(vectors[left], sizes[left])
            for k in right:
                at = left[tree.reach(vectors[k], sizes[k], threshold)]
                at = at[((sides[k] > 0) | (nodes[at] > nodes[k])) & (parts[at] != parts[k])]
                if len(at):
                    yield told(nodes, np.full(len(at), k), at)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # parts of the group at hand, two blocks at most

        def found(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            groups = columns[0]
            starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
            lengths = np.diff(np.append(starts, len(groups)))
            few = np.repeat(lengths <= LEAF, lengths)
            yield from in_leaves(*(c[few] for c in columns))
            for start, length in zip(starts[lengths > LEAF], lengths[lengths > LEAF], strict=True):
                yield from in_tree(*(c[start : start + length] for c in columns[1:]))

        for batch in batches:
            columns = [*(batch.column(k).to_numpy() for k in range(5)), vectors_of(batch.column(5))]
            if not len(columns[0]):
                continue
            if held and held[-1][0][-1] == columns[0][0] == columns[0][-1]:
                held.append(columns)
                continue
            last = len(columns[0]) - int((columns[0] == columns[0][-1]).sum())
            if last:
                yield from found([np.concatenate(c) for c in zip(*held, [c[:last] for c in columns], strict=True)])
                held = []
            elif held and held[-1][0][-1] != columns[0][0]:
                yield from found([np.concatenate(c) for c in zip(*held, strict=True)])
                held = []
            held.append([c[last:] for c in columns])
        if held:
            yield from found([np.concatenate(c) for c in zip(*held, strict=True)])

    groups = compared(shared, keys)
    ids = stored(groups.select(F.col("node").alias("_id")).distinct(), "compared")
    points = semi(points, ids, "node").select("node", "n_shingles", "vector").dropDuplicates(["node"])
    rows = groups.join(points, "node").select("group", "node", "side", "component", "n_shingles", "vector")
    dealt = rows.repartition(partitions(rows.sparkSession), "group").sortWithinPartitions("group", "node")
    return dealt.mapInArrow(search, "a long, b long").distinct()


def with_nodes(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame | None]:
    """``_id, _node, _text`` of every row, and ``_id, _text_hash, _node`` of texts that share their id with another text,
    or None if there are none.

    Such a text is a node of its own, numbered after the largest id; every other one has its id as its node.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.coalesce(text_column, F.lit("")).alias("_text"))
    keyed_rows = rows.withColumn("_text_hash", F.xxhash64("_text"))
    several = keyed_rows.where("_id is not null").groupBy("_id").agg(F.min("_text_hash").alias("_low"), F.max("_text_hash").alias("_high"))
    several = stored(several.where("_low <> _high").select("_id"), "ids-of-several-texts")
    if not several.limit(1).count():
        return rows.select("_id", F.col("_id").alias("_node"), "_text"), None
    texts = semi(keyed_rows, several, "_id").select("_id", "_text_hash").distinct()
    highest = rows.agg(F.max("_id")).first()[0]
    if highest + several.count() * 2 > (1 << 62):
        raise ValueError("ids are too large for texts that share one to be numbered after them")
    named = numbered(texts, [], F.struct("_id", "_text_hash"), [F.col("_id"), F.col("_text_hash")], "_number")
    named = stored(named.select("_id", "_text_hash", (F.col("_number") + highest + 1).alias("_node")), "nodes")
    found = keyed_rows.join(sent_if_few(named), ["_id", "_text_hash"], "left")
    return found.select("_id", F.coalesce("_node", "_id").alias("_node"), "_text"), named


def linked(rows: DataFrame, words: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """``node, n_shingles`` of every row (``_node, _text``; one text per node), and links ``a, b`` that join each component."""
    measured = stored(keyed(rows.select("_node", "_text"), words, threshold), "points")
    linkable = measured.where("n_shingles > 0 and node is not null")
    # only sets that occur more than once are joined; a set may hold a third of all rows
    sets = linkable.groupBy("n_shingles", "_k1", "_k2").agg(F.min("node").alias("first"), F.max("node").alias("_last")).where("first <> _last").drop("_last")
    sets = stored(sets, "equal-sets")
    equal = linkable.select("node", "n_shingles", "_k1", "_k2").join(sent_if_few(sets), ["n_shingles", "_k1", "_k2"])
    equal = stored(equal.where("node <> first").select("first", "node").distinct(), "equal-nodes")

    def by_first(frame: DataFrame, column: str) -> DataFrame:
        """``column`` replaced by the smallest node with the same n-grams."""
        to = sent_if_few(equal).select(F.col("node").alias("_n"), F.col("first").alias("_f"))
        return frame.join(to, frame[column] == to["_n"], "left").withColumn(column, F.coalesce("_f", column)).drop("_n", "_f")

    texts = rows.where("_node is not null").select("_node", "_text")
    points = linkable.select("node", "n_shingles", "vector", "fine")
    shared = stored(by_first(shared_keys(measured), "node").select("key", "node", "leader"), "shared-keys")
    pairs = by_first(shared.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "a")
    pairs = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    spark = rows.sparkSession
    links = only_last(spark, lambda: verified(bounded(pairs, points, threshold), texts, words, threshold))

    part = components(links)
    members = shared.select("key", "node").join(sent_if_few(part), "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    members = members.repartition(partitions(rows.sparkSession), "key").dropDuplicates(["key", "node"])  # one exchange, also for the next count
    mixed_keys = members.groupBy("key").agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count(F.lit(1)).alias("n")).where("_low <> _high").select("key", "n")


    def crossing() -> DataFrame:
        found = across(members, stored(mixed_keys, "mixed-keys"), points, threshold)
        return verified(bounded(found, points, threshold), texts, words, threshold)

    more = only_last(spark, crossing)
    links = links.unionByName(more).unionByName(equal.select(F.col("first").alias("a"), F.col("node").alias("b")))
    return measured.select("node", "n_shingles"), links


def near_duplicates(docs: DataFrame, words: int = 4, threshold: int = 85, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Two documents are linked if ``100 * intersection >= threshold * union`` of their distinct n-grams.
    ``component_id`` is the smallest id reachable by links, its own included. A null or empty text and one of
    white space alone has no n-grams and no links. Rows that repeat an id are one document, with the links of all
    their texts, and are returned as often as they occur. A null id has no links and a null component. An empty table
    gives no rows. No other column is read.
    """
    small_batches(docs.sparkSession)

    def classes() -> DataFrame:
        rows, named = with_nodes(docs, id_column, text_column)
        measured, links = linked(rows, words, threshold)
        if named is not None:
            links = links.unionByName(named.select(F.col("_id").alias("a"), F.col("_node").alias("b")))
            measured = measured.join(sent_if_few(named.select("_id", "_node")), F.col("node") == F.col("_node"), "left").withColumn("node", F.coalesce("_id", "node"))
        part = components(links)
        found = measured.select(F.col("node").alias("doc_id"), "n_shingles")
        found = found.join(part, found["doc_id"] == part["node"], "left")
        return stored(found.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")), "classes")

    return only_last(docs.sparkSession, classes)


def one_of_each(docs: DataFrame, words: int = 5, threshold: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` without those linked to a smaller id, columns as they are.

    Of rows that repeat both id and text, one stays. Different texts under one id are documents of their own, which
    come after all whose id is their own. Rows with a null id and, but for repeated ones, those without a word all stay.
    An empty table stays empty.
    """
    small_batches(docs.sparkSession)
    rows, named = with_nodes(docs, id_column, text_column)


    def duplicates() -> DataFrame:
        _, links = linked(rows, words, threshold)
        return stored(components(links).where("component <> node").select("node"), "duplicates")

    gone = only_last(docs.sparkSession, duplicates)
    few = sent_if_few(gone)
    kept = docs.join(few, docs[id_column] == few["node"], "left_anti")
    text_hash = F.xxhash64(F.coalesce(docs[text_column], F.lit("")))
    if named is not None:
        texts = stored(named.join(few, F.col("_node") == F.col("node")).select("_id", "_text_hash"), "duplicate-texts")
        texts = sent_if_few(texts)
        kept = kept.join(texts, (docs[id_column] == texts["_id"]) & (text_hash == texts["_text_hash"]), "left_anti")
    ids = docs.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("_id")).count().where("count > 1").select("_id")
    repeated = stored(ids, "repeated-ids")
    if not repeated.limit(1).count():
        return kept
    again = semi(kept, repeated, id_column).dropDuplicates([id_column, text_column])
    return kept.join(repeated, kept[id_column] == repeated["_id"], "left_anti").unionByName(again)
