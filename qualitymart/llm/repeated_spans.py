"""Substring dedup: words under a window of ``WINDOW`` words that also starts earlier, by de Bruijn compaction.

The windows (token k-mers) are the edges of a de Bruijn graph over the corpus, and a document is a walk through it.

1. Paths. Consecutive windows that share their minimizer (the ``ANCHOR`` words in them with the least hash) are one path.
   Equal windows have the same minimizer, so all occurrences of an edge lie in paths of one minimizer, and a path is
   keyed by that and by the hash of its words. A task first compares its own paths, so that of a group of copies only one
   per task is shuffled. Then paths of one minimizer meet: equal paths are repeated as a whole.
2. Branches. Where a minimizer has several different paths, the graph may branch inside them. The first occurrence of each
   such path is cut into single edges, and these meet by their own hash.
3. Compaction. Repeated pieces of a document that go on both there and at their source without a gap are one nonbranching
   path, and are joined into one span.
4. Verification. The words of every span are hashed anew (128 bits) at its own coordinates and, in the text of
   the source, at those of the source; only spans that agree are removed.

"Earlier" is a smaller document id, or an earlier word of the same document. A null id comes after all others. Rows
that repeat an id with different texts follow each other in the order of a hash of their text; rows with both the same
are one document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualitymart.llm.common import only_last, partitions, small_batches, stored
from qualitymart.llm.token_counts import texts_of
from qualitymart.llm.words import Prefixes, hashed, mixed, words_of

WINDOW, ANCHOR = 20, 5
#: Windows, or edges, that a task compares among themselves before it passes them on.
HELD = 1 << 21
#: Words that are cut together.
AT_ONCE = 1 << 18
#: A table of documents is sent to all tasks if it has at most this many rows (24 MB), else it is joined by a shuffle.
SENT = 1_000_000
#: A minimizer of at least one in so many paths is dealt out by path; there are no more such minimizers than that.
HOT = 20_000
#: Paths of one in so many documents tell which minimizers are hot.
SAMPLED = 32

#: Pieces of documents: ``size`` windows from ``start`` on. With a source they are repeated and start there earlier.
PIECE = "m long, p long, doc long, tie long, start int, size int, from_doc long, from_tie long, from_start int"
#: What a null id is counted as.
LAST = (1 << 63) - 1


class Pieces:
    """Pieces of the documents a task has read so far, compared among themselves when there are enough."""

    def __init__(self) -> None:
        self.docs: list[tuple[int, int]] = []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.n = 0

    def add(self, doc: tuple[int, int], m: np.ndarray, p: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        if len(m):
            self.parts.append((m, p, np.full(len(m), len(self.docs), np.int64), start, size))
            self.docs.append(doc)
            self.n += len(m)

    def told(self) -> Iterator[pa.RecordBatch]:
        """The earliest piece of each key without a source, all others with it; these joined where they go on."""
        if not self.n:
            return
        m, p, doc, start, size = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        names = np.array(self.docs, np.int64)
        self.__init__()
        place = np.unique(names, axis=0, return_inverse=True)[1].reshape(-1)  # equal documents have equal places
        earlier = np.lexsort((start, place[doc]))
        key = mixed(m ^ mixed(p, 1), 2)
        order = earlier[np.argsort(key[earlier], kind="stable")]
        m, p, doc, start, size = m[order], p[order], doc[order], start[order], size[order]
        new = np.concatenate([[True], (m[1:] != m[:-1]) | (p[1:] != p[:-1])])
        source = np.flatnonzero(new)[np.cumsum(new) - 1]
        place = place[doc]
        same = (place == place[source]) & (start == start[source])  # of one place: the piece itself, or a repeated row
        yield from self.batches(m[new], p[new], names[doc[new]], start[new], size[new], None, None)
        rows = np.flatnonzero(~same)
        rows = rows[np.lexsort((start[rows], doc[rows]))]
        if len(rows):
            d, s, n, fd, fs = doc[rows], start[rows], size[rows], doc[source[rows]], start[source[rows]]
            goes_on = (d[1:] == d[:-1]) & (s[1:] == s[:-1] + n[:-1]) & (fd[1:] == fd[:-1]) & (fs[1:] - fs[:-1] == s[1:] - s[:-1])
            first = np.flatnonzero(np.concatenate([[True], ~goes_on]))
            yield from self.batches(None, None, names[d[first]], s[first], np.add.reduceat(n, first), names[fd[first]], fs[first])

    @staticmethod
    def batches(m, p, names, start, size, from_names, from_start) -> Iterator[pa.RecordBatch]:
        n = len(start)
        empty = lambda kind: pa.nulls(n, kind)
        whole = lambda x: empty(pa.int64()) if x is None else pa.array(x.view(np.int64))
        of = [empty(pa.int64())] * 2 + [empty(pa.int32())] if from_names is None else [pa.array(from_names[:, 0]), pa.array(from_names[:, 1]), pa.array(from_start, pa.int32())]
        batch = pa.record_batch([whole(m), whole(p), pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array(start, pa.int32()), pa.array(size, pa.int32()), *of], names=[c.split()[0] for c in PIECE.split(", ")])
        for k in range(0, n, 50_000):
            yield batch.slice(k, 50_000)


def paths_of(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``text, m, p, start, size`` of the paths of texts that lie one after the other in ``ids``."""
    n = len(ids) - WINDOW + 1
    if n < 1:
        return
    prefixes = Prefixes(ids)
    anchors = mixed(prefixes.of(np.arange(len(ids) - ANCHOR + 1), ANCHOR), 3)
    at = np.lib.stride_tricks.sliding_window_view(anchors, WINDOW - ANCHOR + 1).argmin(1) + np.arange(n)
    first = np.concatenate([[True], at[1:] != at[:-1]])
    for text, (start, length) in enumerate(zip(starts, lengths, strict=True)):
        windows = length - WINDOW + 1
        if windows < 1:
            continue
        new = first[start : start + windows].copy()
        new[0] = True
        begin = np.flatnonzero(new) + start
        size = np.diff(np.append(begin, start + windows))
        yield text, anchors[at[begin]], prefixes.of(begin, size + (WINDOW - 1)), begin - start, size


def document_of(id_column: str, text_column: str, docs: DataFrame) -> DataFrame:
    """``_doc, _tie, _text``: ids with null as the last; the tie is 0 but for ids that several rows have."""
    rows = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)).alias("_doc"), F.coalesce(text_column, F.lit("")).alias("_text"))
    repeated = stored(rows.groupBy("_doc").count().where("count > 1").select(F.col("_doc").alias("_again")), "repeated-ids")
    n = repeated.limit(SENT + 1).count()
    if not n:
        return rows.select("_doc", F.lit(0).cast("long").alias("_tie"), "_text")
    found = rows.join(F.broadcast(repeated) if n <= SENT else repeated, F.col("_doc") == F.col("_again"), "left")
    return found.select("_doc", F.when(F.col("_again").isNotNull(), F.xxhash64("_text")).otherwise(0).alias("_tie"), "_text")


def cut_paths(rows: DataFrame) -> DataFrame:
    """The paths of all documents; those that another one of the same task repeats have a source."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, names, ids = Pieces(), [], []

        def cut_held() -> None:
            lengths = np.array([len(x) for x in ids])
            starts = np.cumsum(lengths) - lengths
            for text, *path in paths_of(np.concatenate(ids), starts, lengths):
                pieces.add(names[text], *path)
            names.clear()
            ids.clear()

        volume = 0
        for batch in batches:
            docs, ties = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k, text in texts_of(batch, 2):
                words = words_of(text)
                if len(words) < WINDOW:
                    continue
                names.append((docs[k], ties[k]))
                ids.append(hashed(words))
                volume += len(words)
                if volume >= AT_ONCE:
                    cut_held()
                    volume = 0
                    if pieces.n >= HELD:
                        yield from pieces.told()
        if ids:
            cut_held()
        yield from pieces.told()

    return rows.select("_doc", "_tie", "_text").mapInArrow(cut, PIECE)


def cut_edges(rows: DataFrame) -> DataFrame:
    """The single windows of ``parts`` (start, size, m) of each document (``_doc, _tie, _text``)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces()
        for batch in batches:
            docs, ties, parts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
            for k, text in texts_of(batch, 2):
                prefixes = Prefixes(hashed(words_of(text)))
                of = parts[k].as_py()
                size = np.array([x["size"] for x in of])
                before = np.repeat(np.cumsum(size) - size, size)
                start = np.repeat(np.array([x["start"] for x in of]), size) + np.arange(int(size.sum())) - before
                m = np.repeat(np.array([x["m"] for x in of], np.int64), size).view(np.uint64)
                pieces.add((docs[k], ties[k]), m, prefixes.of(start, WINDOW), start, np.ones(len(start), np.int64))
                if pieces.n >= HELD:
                    yield from pieces.told()
        yield from pieces.told()

    return rows.select("_doc", "_tie", "_text", "parts").mapInArrow(cut, PIECE)


REPEAT = ["doc", "tie", "start", "size", "from_doc", "from_tie", "from_start"]


def here() -> Column:
    """The place of a piece; "earlier" is smaller."""
    return F.struct("doc", "tie", "start")


def with_first(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """``pieces`` with ``_first``, the earliest occurrence of their path or edge."""
    return pieces.withColumn("_first", F.min(here()).over(Window.partitionBy(*keys)))


def repeats_in(pieces: DataFrame) -> DataFrame:
    """Those that are not the first, with it as their source."""
    found = pieces.where(here() != F.col("_first"))
    return found.select(*REPEAT[:4], F.col("_first.doc").alias("from_doc"), F.col("_first.tie").alias("from_tie"), F.col("_first.start").alias("from_start"))


def hot_minimizers(paths: DataFrame) -> DataFrame:
    """``m`` of the minimizers that many paths of a sample of documents have; only where the paths meet depends on it."""
    some = paths.where(F.pmod(F.xxhash64("doc", "tie"), F.lit(SAMPLED)) == 0)
    total = some.count()
    counts = some.groupBy("m").count()
    return counts.where((F.col("count") >= 16) & (F.col("count") * HOT >= total)).select("m").withColumn("_hot", F.lit(True))


def compacted(pieces: DataFrame) -> DataFrame:
    """Pieces that go on both in their document and at their source, as one span with ``words`` words."""
    line = ["doc", "tie", "from_doc", "from_tie", "_shift"]
    along = Window.partitionBy(*line).orderBy("start", "size")
    reached = F.max(F.col("start") + F.col("size")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    rows = pieces.withColumn("_shift", F.col("start") - F.col("from_start")).withColumn("_reached", reached)
    rows = rows.withColumn("_span", F.sum(F.coalesce(F.col("start") > F.col("_reached"), F.lit(True)).cast("int")).over(along))
    spans = rows.groupBy(*line, "_span").agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("size")).alias("_end"))
    words = (F.col("_end") - F.col("start") + (WINDOW - 1)).alias("words")
    return spans.select("doc", "tie", "start", words, "from_doc", "from_tie", (F.col("start") - F.col("_shift")).alias("from_start"))


def of_documents(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` (documents) with the columns of ``wanted`` (one row per ``doc, tie``), without the others."""
    few = wanted.select("doc", "tie")
    same = lambda w: (rows["_doc"] == w["doc"]) & (rows["_tie"] == w["tie"])
    if few.limit(SENT + 1).count() <= SENT:
        rows = rows.join(F.broadcast(few), same(few), "left_semi")
    return rows.join(wanted, same(wanted)).drop("doc", "tie")


def digest(words: list[bytes], start: int, length: int) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words[start : start + length]))


def source_digests(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``from_doc, from_tie, from_start, words, digest``: what the sources of the spans hold at their coordinates."""
    asked = spans.select("from_doc", "from_tie", "from_start", "words").distinct()
    wanted = asked.groupBy(F.col("from_doc").alias("doc"), F.col("from_tie").alias("tie")).agg(F.collect_set(F.struct("from_start", "words")).alias("parts"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, ties, parts = batch.column(0), batch.column(1), batch.column(3)
            at, starts, lengths, found = [], [], [], []
            for k, text in texts_of(batch, 2):
                words = words_of(text)
                for part in parts[k].as_py():
                    at.append(k)
                    starts.append(part["from_start"])
                    lengths.append(part["words"])
                    found.append(digest(words, part["from_start"], part["words"]))
            index = pa.array(at, pa.int64())
            yield pa.record_batch([docs.take(index), ties.take(index), pa.array(starts, pa.int32()), pa.array(lengths, pa.int32()), pa.array(found, pa.binary())], ["from_doc", "from_tie", "from_start", "words", "digest"])

    found = of_documents(rows, stored(wanted, "sources")).select("_doc", "_tie", "_text", "parts")
    # rows that repeat id and text say the same
    return found.mapInArrow(look, "from_doc long, from_tie long, from_start int, words int, digest binary").distinct()


def repeated_spans(rows: DataFrame) -> DataFrame:
    """Spans ``doc, tie, start, words, from_doc, from_tie, from_start`` of ``rows`` (``_doc, _tie, _text``) whose every
    window also starts earlier, at the source."""
    n = partitions(rows.sparkSession)
    paths = stored(cut_paths(rows), "paths")
    first = paths.where("from_doc is null").drop("from_doc", "from_tie", "from_start")
    hot = stored(hot_minimizers(first), "hot-minimizers")  # HOT rows at most
    dealt = first.join(F.broadcast(hot), "m", "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod("p", F.lit(n))).otherwise(-1))
    # one exchange by minimizer, for both the paths and the question whether there are several
    met = with_first(dealt.repartition(n, "m", "_salt"), ["m", "_salt", "p"])
    each = Window.partitionBy("m", "_salt")
    met = met.withColumn("_branches", F.coalesce("_hot", F.lit(False)) | (F.min("p").over(each) != F.max("p").over(each)))
    met = stored(met.where(F.col("_branches") | (here() != F.col("_first"))), "met-paths")

    branches = met.where(F.col("_branches") & (here() == F.col("_first"))).groupBy("doc", "tie").agg(F.collect_set(F.struct("start", "size", "m")).alias("parts"))
    edges = stored(cut_edges(of_documents(rows, stored(branches, "branches"))), "edges")
    met_edges = with_first(edges.where("from_doc is null"), ["m", "p"])

    local = paths.unionByName(edges).where("from_doc is not null").select(*REPEAT)
    return compacted(local.unionByName(repeats_in(met)).unionByName(repeats_in(met_edges)).distinct())


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, spans, kept_sha256`` of every row; ``spans`` holds start and end of the removed words, null if none.

    ``kept_sha256`` is of the words that stay, joined by one space. A null, empty or blank text has no words. Rows that
    repeat id and text are one document, each is returned. Null ids come after all others. An empty table gives no rows.
    No other columns are read.
    """
    small_batches(docs.sparkSession)
    rows = document_of(id_column, text_column, docs)

    def removals() -> DataFrame:
        spans = only_last(docs.sparkSession, lambda: stored(repeated_spans(rows), "spans"))
        verified = spans.join(source_digests(rows, spans), ["from_doc", "from_tie", "from_start", "words"])
        return stored(verified.groupBy("doc", "tie").agg(F.collect_set(F.struct("start", "words", "digest")).alias("parts")), "removals")

    wanted = only_last(docs.sparkSession, removals)

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spans, hashes = [], [], []
            for k, text in texts_of(batch, 2):
                words = words_of(text)
                keep = np.ones(len(words), bool)
                for part in batch.column(3)[k].as_py():
                    if digest(words, part["start"], part["words"]) == part["digest"]:
                        keep[part["start"] : part["start"] + part["words"]] = False
                edge = np.diff(np.concatenate([[1], keep, [1]]).astype(np.int8))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(edge < 0), np.flatnonzero(edge > 0), strict=True)])
                counts.append(int((~keep).sum()))
                hashes.append(hashlib.sha256(b" ".join([words[j] for j in np.flatnonzero(keep)])).hexdigest())
            out = [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(hashes)]
            yield pa.record_batch(out, ["doc", "tie", "_removed", "spans", "_kept"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [words_of(text) for _, text in texts_of(batch, 2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(map(len, found), pa.int64()), pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in found], pa.string())], ["_doc", "_tie", "n_words", "_whole"])

    layout = "doc long, tie long, _removed long, spans array<struct<start: int, end: int>>, _kept string"
    changed = of_documents(rows, wanted).select("_doc", "_tie", "_text", "parts").mapInArrow(removed, layout).dropDuplicates(["doc", "tie"])
    every = rows.select("_doc", "_tie", "_text").mapInArrow(whole, "_doc long, _tie long, n_words long, _whole string")
    found = every.join(changed, (F.col("_doc") == F.col("doc")) & (F.col("_tie") == F.col("tie")), "left")
    return found.select(
        F.when(F.col("_doc") != LAST, F.col("_doc")).alias("doc_id"),
        "n_words",
        F.coalesce("_removed", F.lit(0)).alias("n_removed"),
        "spans",
        F.coalesce("_kept", "_whole").alias("kept_sha256"),
    )
