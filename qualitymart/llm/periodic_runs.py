"""Periodic runs of words: stretches that repeat a sequence of words at least three times.

A run of period q is a maximal stretch in which words q apart are identical, q being its smallest period.
Periods are dealt by octave (1 to 15, 16 to 31, 32 to 63, ...). In the octave from P on, a document is cut into overlapping
tiles, one around each boundary c that is a multiple of P, reaching from c - P to c + 5P. A run of at
least three periods holds two periods after some boundary, so a tile of its own octave shows it, and the
last such tile reaches beyond its end.

1. The tiles in which two equal blocks of P words start at c and at most 2P further on, and no others, are
   exploded into rows, with the words as numbers.
2. Every tile is solved by itself, wherever it is: the Z-function of the words from c on tells how far each period goes
   on, the one of the reversed words how far it reaches back. A tile returns an interval per period.
3. Intervals are dealt by document and period; those that overlap by a period or more are one run.

A document is only ever the text, so copies are solved once. What is shuffled are tiles that hold a
repetition, and intervals.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qualitymart.llm.common import partitions, small_batches, stored
from qualitymart.llm.token_counts import texts_of
from qualitymart.llm.words import mixed, words_of

#: The first octave holds all periods below twice this; a run has three times as many words at least.
FIRST = 8
LEAST = 3 * FIRST
#: Words that are screened together.
AT_ONCE = 1 << 18
#: Texts a task remembers having cut.
SEEN = 100_000
#: Runs are sent to all tasks if they have at most this many bytes.
SENT = 32 << 20

TILE = "k1 long, k2 long, octave int, at int, start int, words binary"
RUN = "array<struct<start: int, period: int, length: int>>"


def smaller_period(words: np.ndarray, octave: int) -> bool:
    """Whether the words have one period below ``octave`` throughout; then no run of this octave starts to repeat here."""
    for p in np.flatnonzero(words[1:octave] == words[0]) + 1:
        if np.array_equal(words[p:], words[:-p]):
            return True
    return False


def tiles_of(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, longest: int) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """``text, octave, boundary, first word, words`` of the tiles of texts that lie in ``ids`` from ``starts`` to ``ends``.

    Between two texts is a number that occurs nowhere else, so no equal blocks cross it.
    """
    blocks, size = ids.astype(np.uint64), 1
    octave = FIRST
    while 3 * octave <= longest:
        while size < octave:
            with np.errstate(over="ignore"):
                blocks = mixed(blocks[:-size], size) + blocks[size:]
            size *= 2
        odd = mixed(np.arange(2 * octave, dtype=np.uint64), 99)  # beyond the end nothing is equal
        view = np.lib.stride_tricks.sliding_window_view(np.concatenate([blocks, odd]), 2 * octave)[: len(blocks) : octave]
        low = 1 if octave == FIRST else octave
        for row in np.flatnonzero((view[:, low:] == view[:, :1]).any(1)):
            c = int(row) * octave
            text = int(np.searchsorted(starts, c, "right")) - 1
            start, end = int(starts[text]), int(ends[text])
            if c >= end or (octave > FIRST and smaller_period(ids[c : min(c + 4 * octave, end)], octave)):
                continue
            first = max(start, c - octave)
            yield text, octave, c - start, first - start, ids[first : min(c + 5 * octave, end)]
        octave *= 2


def z_function(words: list, upto: int) -> list[int]:
    """For each place below ``upto``, how many words from there on equal those from the first on."""
    z, left, right = [0] * min(upto, len(words)), 0, 0
    n = len(words)
    for k in range(1, len(z)):
        same = min(right - k, z[k - left]) if k < right else 0
        while k + same < n and words[same] == words[k + same]:
            same += 1
        if k + same > right:
            left, right = k, k + same
        z[k] = same
    return z


def intervals(words: list, boundary: int, octave: int) -> Iterator[tuple[int, int, int]]:
    """``period, start, end`` of the stretches, within a tile, that repeat a period of the octave after ``boundary``."""
    z = z_function(words[boundary:], 2 * octave)
    found = []
    for q in range(1 if octave == FIRST else octave, len(z)):
        if z[q] >= max(q, FIRST) and not any(q % d == 0 and z[d] >= q - d for d in range(1, q // 2 + 1)):
            found.append(q)
    if found:
        before = words[:boundary][::-1]
        top = found[-1]
        back = z_function([*before, None, *words[: boundary + top][::-1]], len(before) + 2 + top)
        for q in found:
            yield q, boundary - back[len(before) + 1 + top - q], boundary + q + z[q]


def cut_tiles(rows: DataFrame) -> DataFrame:
    """The tiles of all texts (``_k1, _k2, _text``) that hold a repetition."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()

        def told(keys: list, texts: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
            numbers: defaultdict[bytes, int] = defaultdict(lambda: len(numbers))
            ids, starts, at = [], [], 0
            for k, words in enumerate(texts):
                ids.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
                ids.append(np.array([0xFFFFFFFF - k], np.uint32))
                starts.append(at)
                at += len(words) + 1
            lengths = np.array([len(t) for t in texts])
            columns: list[list] = [[] for _ in range(6)]
            volume = 0
            for text, octave, boundary, first, words in tiles_of(np.concatenate(ids), np.array(starts), np.array(starts) + lengths, int(lengths.max())):
                for column, value in zip(columns, (*keys[text], octave, boundary, first, words.astype("<u4").tobytes()), strict=True):
                    column.append(value)
                volume += 4 * len(words)
                if volume > 4 << 20:
                    yield batch_of(columns)
                    columns, volume = [[] for _ in range(6)], 0
            if columns[0]:
                yield batch_of(columns)

        def batch_of(columns: list[list]) -> pa.RecordBatch:
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["k1", "k2", "octave", "at", "start", "words"])

        held: dict[int, tuple[list, list]] = {}  # texts by the number of their octaves
        sizes: dict[int, int] = defaultdict(int)
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            if len(seen) > SEEN:
                seen.clear()
            for k, text in texts_of(batch, 2):
                if keys[k] in seen:
                    continue
                seen.add(keys[k])
                words = words_of(text)
                if len(words) < LEAST:
                    continue
                octaves = (len(words) // LEAST).bit_length()
                of_keys, texts = held.setdefault(octaves, ([], []))
                of_keys.append(keys[k])
                texts.append(words)
                sizes[octaves] += len(words)
                if sizes[octaves] >= AT_ONCE:
                    yield from told(*held.pop(octaves))
                    sizes[octaves] = 0
        for octaves in list(held):
            yield from told(*held.pop(octaves))

    return rows.select("_k1", "_k2", "_text").mapInArrow(cut, TILE)


def solve_tiles(tiles: DataFrame) -> DataFrame:
    """``k1, k2, period, start, end`` of the repetitions in each tile, every one by itself."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                words = np.frombuffer(r["words"], "<u4").tolist()
                rows += [(r["k1"], r["k2"], q, r["start"] + a, r["start"] + b) for q, a, b in intervals(words, r["at"] - r["start"], r["octave"])]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["k1", "k2", "period", "start", "end"])

    return tiles.mapInArrow(solve, "k1 long, k2 long, period int, start int, end int")


def stitched(fragments: DataFrame, least: int, times: int) -> DataFrame:
    """``k1, k2, runs``: intervals of one document and period that overlap by a period or more are one run."""
    group = ["k1", "k2", "period"]
    inside = Window.partitionBy(*group).orderBy("start", "end")
    reached = F.max("end").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("start") + F.col("period") > F.col("_reached"), F.lit(True))
    rows = fragments.distinct().withColumn("_reached", reached).withColumn("_run", F.sum(new.cast("int")).over(inside))
    runs = rows.groupBy(*group, "_run").agg(F.min("start").alias("start"), F.max("end").alias("_end"))
    runs = runs.withColumn("length", F.col("_end") - F.col("start")).where(F.col("length") >= F.greatest(F.lit(least), F.lit(times) * F.col("period")))
    found = F.sort_array(F.collect_list(F.struct("start", "period", "length")))
    return runs.groupBy("k1", "k2").agg(found.alias("runs"))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words without those that any run (``start, period, length``) holds after its first period."""
    keep = np.ones(len(words), bool)
    for start, period, length in runs:
        keep[start + period : start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(keep)] if runs else words).decode("utf-8", "replace")


def find_runs(docs: DataFrame, least: int = 24, times: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row.

    ``runs`` holds start, period and length (in words) of every maximal stretch with at least ``least``
    words (24 or more) and ``times`` periods (3 or more), by start, then period. ``collapsed`` is the text's words joined by one
    space, without the repetitions: of each run, only the first period stays. A null, empty or blank text
    has no words, no runs and an empty ``collapsed``. Rows are judged by their text alone, so a null id, a repeated id and
    repeated rows are returned as they come. An empty table gives no rows. No other column is read.
    """
    if least < LEAST or times < 3:
        raise ValueError(f"runs have at least {LEAST} words and three periods")
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(text_column, F.lit(""))
    rows = docs.select(F.col(id_column).alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit(1), text).alias("_k2"))
    id_type = rows.schema["_id"].dataType.simpleString()

    tiles = cut_tiles(rows).repartition(partitions(spark), "k1", "k2", "octave", "at")
    runs = stored(stitched(solve_tiles(tiles), least, times), "runs")
    volume = runs.agg(F.sum(F.lit(40) + 12 * F.size("runs"))).first()[0] or 0
    found = rows.join(F.broadcast(runs) if volume <= SENT else runs, (rows["_k1"] == runs["k1"]) & (rows["_k2"] == runs["k2"]), "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, texts = [], []
            of = batch.column(2)
            for k, value in texts_of(batch, 1):
                words = words_of(value)
                counts.append(len(words))
                texts.append(collapse(words, [(r["start"], r["period"], r["length"]) for r in of[k].as_py() or []]))
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64()), of, pa.array(texts, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    empty = F.coalesce(F.col("runs"), F.expr(f"cast(array() as {RUN})"))
    return found.select("_id", "_text", empty.alias("runs")).mapInArrow(finish, f"doc_id {id_type}, n_words long, runs {RUN}, collapsed string")
