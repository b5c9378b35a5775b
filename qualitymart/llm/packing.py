"""Packing of documents into sequences of fixed length, by fitting patterns to the histogram of lengths.

A pattern is two or three lengths that fill a sequence exactly. How often each pattern is used is fitted
to the histogram by non-negative least squares, rounded to whole sequences that the histogram still
allows, and the pieces left over are packed best-fit decreasing. All of this sees the histogram alone,
which has at most ``capacity`` entries; the pieces are then numbered within their length, in parallel,
and the number of a piece decides its sequence.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualitymart.llm.common import numbered, small_batches, stored
from qualitymart.llm.token_counts import texts_of
from qualitymart.llm.tokens import load


@dataclass
class Runs:
    """Which pieces go where: the ``count`` pieces of ``length`` from number ``first`` on go, one each, to
    the sequences from ``sequence`` on, at ``offset``."""

    rows: list[tuple[int, int, int, int]] = field(default_factory=list)
    placed: dict[int, int] = field(default_factory=dict)
    sequences: int = 0

    def put(self, length: int, count: int, sequence: int, offset: int) -> None:
        first = self.placed.get(length, 0)
        self.rows.append((length, first, sequence, offset))
        self.placed[length] = first + count


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All ``(a, b, c)`` with ``a >= b >= c`` of the given lengths that sum to ``capacity``; ``c`` may be 0."""
    have = np.zeros(capacity + 1, bool)
    have[lengths] = True
    have[0] = True
    found = []
    for c in np.flatnonzero(have):
        b = np.arange(max(c, 1), (capacity - c) // 2 + 1)
        a = capacity - c - b
        keep = (a >= b) & have[b] & have[a]
        found.append(np.stack([a[keep], b[keep], np.full(keep.sum(), c)], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 3), int)


def fit(shapes: np.ndarray, histogram: np.ndarray, steps: int = 400) -> np.ndarray:
    """Repeat counts ``x >= 0`` of the patterns that bring their use of each length close to the histogram:
    accelerated projected gradient on the squared error, longer pieces weighing more as they are harder
    to place later."""
    size = len(histogram)
    weight = np.sqrt(np.arange(size) / (size - 1))
    weight[0] = 0
    scale = max(histogram.sum(), 1)
    target = histogram / scale
    x = np.zeros(len(shapes))
    y, t = x, 1.0
    use = np.bincount(shapes.ravel(), np.repeat((weight**2)[shapes].sum(1), 3), size)  # bounds the gradient's growth
    step = 1 / np.maximum((use * weight)[shapes].max(1).max(), 1e-12)
    for _ in range(steps):
        error = (np.bincount(shapes.ravel(), np.repeat(y, 3), size) - target) * weight**2
        new = np.maximum(y - step * error[shapes].sum(1), 0)
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        y = new + (last - 1) / t * (new - x)
        x = new
    return x * scale


def best_fit(runs: Runs, lengths: dict[int, int], capacity: int) -> None:
    """Best-fit decreasing over counts: pieces of one length fill the tightest sequences that take them,
    as many in each as it holds, before the next ones are opened."""
    spaces: list[int] = []
    open_: dict[int, list[tuple[int, int]]] = {}

    def add(space: int, first: int, count: int) -> None:
        if space and count:
            if space not in open_:
                insort(spaces, space)
            open_.setdefault(space, []).append((first, count))

    def fill(length: int, space: int, first: int, bins: int, each: int) -> None:
        for k in range(each):
            runs.put(length, bins, first, capacity - space + k * length)
        add(space - each * length, first, bins)

    for length in sorted(lengths, reverse=True):
        left = lengths[length]
        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, bins = open_[space].pop()
                if not open_[space]:
                    del open_[space]
                    spaces.pop(at)
            else:
                space, first, bins = capacity, runs.sequences, -(-left // (capacity // length))
                runs.sequences += bins
            each = space // length
            whole = min(bins, left // each)
            left -= whole * each
            fill(length, space, first, whole, each) if whole else None
            if whole < bins:
                if left:
                    fill(length, space, first + whole, 1, left)
                    add(space, first + whole + 1, bins - whole - 1)
                    left = 0
                else:
                    add(space, first + whole, bins - whole)


def plan(histogram: dict[int, int], capacity: int) -> Runs:
    """Where the pieces of each length go, for ``{length: pieces}`` with lengths from 1 to ``capacity``."""
    runs = Runs()
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    runs.put(capacity, int(left[capacity]), 0, 0)
    runs.sequences, left[capacity] = int(left[capacity]), 0
    shapes = patterns(np.flatnonzero(left), capacity)
    shapes = shapes[shapes[:, 0] < capacity]
    if len(shapes):
        repeats = fit(shapes, left.astype(float))
        for k in np.argsort(-repeats, kind="stable"):
            parts, times = np.unique(shapes[k][shapes[k] > 0], return_counts=True)
            n = min(int(np.round(repeats[k])), int((left[parts] // times).min()))
            if repeats[k] < 0.5:
                break
            if n > 0:
                offset = 0
                for part, many in zip(parts, times, strict=True):
                    for _ in range(many):
                        runs.put(int(part), n, runs.sequences, offset)
                        offset += int(part)
                left[parts] -= n * times
                runs.sequences += n
    best_fit(runs, {int(k): int(left[k]) for k in np.flatnonzero(left)}, capacity)
    return runs


def pieces_of(docs: DataFrame, path: str, end_id: int, capacity: int, id_column: str, text_column: str) -> DataFrame:
    """``doc_id, _key, piece, start, length, ids_crc32``: documents longer than ``capacity`` are cut into
    pieces of that length, of which the first may be shorter."""
    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.coalesce(text_column, F.lit("")).alias("_text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path)
        for batch in batches:
            ids, keys, out = batch.column(0).to_pylist(), batch.column(2).to_pylist(), []
            for k, text in texts_of(batch, 1):
                tokens = np.append(encoder.ids(text), np.uint32(end_id)).astype("<u4")
                first = (len(tokens) - 1) % capacity + 1
                edges = [0, *range(first, len(tokens) + 1, capacity)]
                out += [(ids[k], keys[k], p, a, b - a, zlib.crc32(tokens[a:b].data)) for p, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
            columns = zip(*out, strict=True) if out else [()] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "_key", "piece", "start", "length", "ids_crc32"])

    return rows.withColumn("_key", F.xxhash64("_text")).mapInArrow(cut, "doc_id long, _key long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, path: str, end_id: int, capacity: int = 1024, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece.

    A null text is empty and has the end id alone. Rows that repeat an id or a text are packed as often as
    they occur. A null id is returned as null. An empty table has no pieces.
    """
    small_batches(docs.sparkSession)
    pieces = stored(pieces_of(docs, path, end_id, capacity, id_column, text_column), "pieces")
    runs = plan({r[0]: r[1] for r in pieces.groupBy("length").count().collect()}, capacity)
    table = np.array(sorted(runs.rows), np.int64).reshape(-1, 4)
    keys = table[:, 0] << 44 | table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            number = batch.column("_number").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length << 44 | number, side="right") - 1
            out = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            out += [pa.array(table[at, 2] + number - table[at, 1]), pa.array(table[at, 3])]
            yield pa.record_batch(out, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    order = [F.col(c) for c in ("doc_id", "_key", "piece")]
    ranked = numbered(pieces, ["length"], F.struct("doc_id", "_key", "piece"), order, "_number")
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
