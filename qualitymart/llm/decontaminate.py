"""Benchmark items in documents: SimHash of item-sized windows, multi-index Hamming search, exact check.

A window is as many words of a document as an item has. Windows that could reach the similarity start at an
n-gram of some item and hold enough n-grams of items; this is counted from where the items' n-grams occur, so
nothing is lost by it and few windows remain. Their SimHash fingerprints are cut into ``RADIUS + 1`` blocks:
two fingerprints that differ in at most ``RADIUS`` bits agree in a whole block, so a join on blocks finds every
item within the radius. Blocks that narrow don't tell items apart, so the join is also on the n-gram that a window starts
with: the most similar window can be taken to start at one of the item's own n-grams, as one that doesn't only gains by
moving on. What it finds is verified by the weighted similarity of the n-grams themselves, each
weighing as often as it occurs.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitymart.llm.common import only_last, stored

#: Bits in which two fingerprints may differ. At a similarity of 0.8 they differ in 10 of 64 bits on average, with a
#: standard deviation of 3.
RADIUS = 19
BITS = 64
#: Tables of at most this many rows and bytes are sent to all tasks; larger ones are joined by a shuffle.
SENT, SENT_BYTES = 1_000_000, 100_000_000


def words_of(text: str) -> Column:
    """Hashes of the lower-cased runs of letters and digits."""
    return F.expr(f"transform(regexp_extract_all(lower({text}), '[\\\\p{{L}}\\\\p{{N}}]+', 0), w -> xxhash64(w))")


def ngrams(words: str, k: int) -> Column:
    """Hashes of all runs of ``k`` words, in order."""
    parts = ", ".join(f"get({words}, i + {j})" for j in range(k))
    return F.expr(f"if(size({words}) >= {k}, transform(sequence(0, size({words}) - {k}), i -> xxhash64({parts})), array())")


def simhash(hashes: str) -> Column:
    """A 64-bit fingerprint: each bit is set if it is in more than half of the hashes. Two counts share a long."""
    pair = "4294967297L"
    counts = f"aggregate({hashes}, array_repeat(0L, 32), (s, h) -> transform(s, (x, i) -> x + (shiftrightunsigned(h, i) & {pair})))"
    low = f"transform(_counts, (x, i) -> if(2 * (x & 4294967295L) > size({hashes}), shiftleft(1L, i), 0L))"
    high = f"transform(_counts, (x, i) -> if(2 * shiftrightunsigned(x, 32) > size({hashes}), shiftleft(1L, i + 32), 0L))"
    bits = f"aggregate(concat({low}, {high}), 0L, (s, x) -> s | x)".replace("_counts", "c")
    return F.expr(f"element_at(transform(array({counts}), c -> {bits}), 1)")


def blocks(radius: int) -> list[tuple[int, int]]:
    """First bit and width of each of ``radius + 1`` blocks."""
    edges = [b * BITS // (radius + 1) for b in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def block_values(fingerprint: str, radius: int) -> Column:
    parts = ", ".join(f"shiftrightunsigned({fingerprint}, {a}) & {(1 << w) - 1}L" for a, w in blocks(radius))
    return F.expr(f"array({parts})")


def first_equal_block(difference: str, radius: int) -> Column:
    """The first block in which no bit differs."""
    cases = " ".join(f"when shiftrightunsigned({difference}, {a}) & {(1 << w) - 1}L = 0 then {k}" for k, (a, w) in enumerate(blocks(radius)))
    return F.expr(f"case {cases} else -1 end")


def overlap(a: str, b: str) -> Column:
    """Size of the intersection of two arrays, each value as often as it is in both."""
    shared = f"array_intersect({a}, {b})"
    repeated = f"size(array_distinct({a})) < size({a}) and size(array_distinct({b})) < size({b})"
    counted = f"aggregate({shared}, 0, (s, h) -> s + least(size(filter({a}, x -> x = h)), size(filter({b}, x -> x = h))))"
    return F.expr(f"if({repeated}, {counted}, size({shared}))")


def row_bytes(rows: DataFrame) -> Column:
    """About the size of a row in memory: 8 bytes a value, and texts and arrays by their length."""
    total = F.lit(16)
    for field in rows.schema:
        if isinstance(field.dataType, T.ArrayType):
            width = 8 * (2 + len(field.dataType.elementType)) if isinstance(field.dataType.elementType, T.StructType) else 8
            total = total + 24 + F.when(F.col(field.name).isNull(), 0).otherwise(F.size(field.name)) * width
        elif isinstance(field.dataType, T.StringType | T.BinaryType):
            total = total + 16 + F.coalesce(F.octet_length(field.name), F.lit(0))
        else:
            total = total + 8
    return total


def sent(small: DataFrame) -> DataFrame:
    """``small`` for a join: with a hint if its size allows it."""
    rows, size = small.limit(SENT + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(small).cast("long")), F.lit(0))).first()
    return F.broadcast(small) if rows <= SENT and size <= SENT_BYTES else small


def candidates(item_grams: DataFrame, radius: int) -> DataFrame:
    """The items' fingerprints by n-gram, block and value: what a window is looked up in."""
    rows = item_grams.select("item_id", F.col("_n").alias("_in"), F.col("_k").alias("_ik"), "_item_print", F.explode(F.array_distinct("_grams")).alias("_ig"))
    return rows.select("*", F.posexplode(block_values("_item_print", radius)).alias("_ib", "_iv"))


def find_items(docs: DataFrame, items: DataFrame, words: int = 5, least: float = 0.8, radius: int = RADIUS, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, similarity, start, n_words, _key``: items in documents, one row for each pair of a
    document and an item, with the most similar window; ``start`` counts words, ``_key`` is the text's hash.

    Words are runs of letters and digits, without case. An item shorter than ``words`` is one n-gram of its
    own length. Null texts, texts and items without a word match nothing. Repeated rows of a document are
    one. Null ids are kept. Empty tables give no rows.
    """
    kept = items.select(F.col(item_column).alias("item_id"), words_of(item_text).alias("_w")).where("size(_w) > 0")
    kept = kept.withColumns({"_n": F.size("_w"), "_k": F.least(F.size("_w"), F.lit(words))})
    lengths = sorted(r[0] for r in kept.select("_k").distinct().collect())
    by_length = [kept.where(F.col("_k") == k).select("item_id", "_n", "_k", ngrams("_w", k).alias("_grams")) for k in lengths]
    if not by_length:
        kind, item_kind = (f.schema[c].dataType.simpleString() for f, c in ((docs, id_column), (items, item_column)))
        return docs.sparkSession.createDataFrame([], f"doc_id {kind}, item_id {item_kind}, similarity double, start int, n_words int, _key long")
    item_grams = by_length[0]
    for more in by_length[1:]:
        item_grams = item_grams.unionByName(more)
    item_grams = stored(item_grams.withColumn("_item_print", simhash("_grams")), "benchmark")
    index = stored(item_grams.select("_n", "_k", F.explode("_grams").alias("_gram")).groupBy("_gram", "_k").agg(F.collect_set("_n").alias("_sizes")), "benchmark-index")

    texts = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("_text")).withColumn("_key", F.xxhash64("_text"))

    def grams(rows: DataFrame) -> DataFrame:
        """``doc_id, _key, _k, _all``: the n-grams of each text, for every length that items have."""
        split = rows.select("doc_id", "_key", words_of("_text").alias("_w"))
        each = F.array(*(F.struct(F.lit(k).alias("_k"), ngrams("_w", k).alias("_all")) for k in lengths))
        if len(lengths) == 1:
            return split.select("doc_id", "_key", F.lit(lengths[0]).alias("_k"), ngrams("_w", lengths[0]).alias("_all"))
        return split.select("doc_id", "_key", F.inline(each))

    # Where n-grams of items are, and the windows that start there and hold enough of them. Arrays are exploded as
    # outer: for a plain explode the optimizer would add a filter on the array's size and move it below the
    # projections, where the words would be found anew for every n-gram.
    found = grams(texts).select("doc_id", "_key", "_k", F.posexplode_outer("_all").alias("_at", "_gram")).join(sent(index), ["_gram", "_k"])
    hits = found.groupBy("doc_id", "_key", "_k").agg(F.array_sort(F.collect_set(F.struct("_at", "_sizes"))).alias("_hits"))
    needed = f"cast(ceil({least} * (_n - _k + 1) - 1e-9) as int)"
    windows = hits.select("doc_id", "_key", "_k", F.col("_hits._at").alias("_places"), F.posexplode_outer("_hits").alias("_j", "_hit"))
    windows = windows.select("doc_id", "_key", "_k", "_places", "_j", F.col("_hit._at").alias("_at"), F.explode("_hit._sizes").alias("_n"))
    windows = windows.where(F.expr(f"get(_places, _j + {needed} - 1) <= _at + _n - _k"))
    windows = windows.groupBy("doc_id", "_key", "_k").agg(F.collect_set(F.struct("_at", "_n")).alias("_windows"))
    windows = stored(windows, "windows")

    # fingerprints of those windows
    few = sent(windows)
    same = [texts["doc_id"].eqNullSafe(few["doc_id"]), texts["_key"] == few["_key"]]
    cut = grams(texts.join(few.select("doc_id", "_key").distinct(), same, "left_semi").dropDuplicates(["doc_id", "_key"]))
    match = cut["doc_id"].eqNullSafe(windows["doc_id"]) & (cut["_key"] == windows["_key"]) & (cut["_k"] == windows["_k"])
    cut = cut.join(windows, match).select(cut["doc_id"], cut["_key"], cut["_k"], "_all", F.explode("_windows").alias("_w"))
    cut = cut.select("doc_id", "_key", "_k", F.col("_w._at").alias("_at"), F.col("_w._n").alias("_n"), F.expr("slice(_all, _w._at + 1, _w._n - _k + 1)").alias("_window"))
    cut = cut.withColumn("_print", simhash("_window"))

    # items that agree in a block, are within the radius and are similar
    left = cut.select("*", F.get("_window", F.lit(0)).alias("_first"), F.posexplode_outer(block_values("_print", radius)).alias("_block", "_value"))
    right = candidates(item_grams, radius)
    same_block = (F.col("_block") == F.col("_ib")) & (F.col("_value") == F.col("_iv")) & (F.col("_first") == F.col("_ig"))
    near = left.join(sent(right), same_block & (F.col("_n") == F.col("_in")) & (F.col("_k") == F.col("_ik")))
    near = near.withColumn("_apart", F.expr("_print ^ _item_print")).where((F.bit_count("_apart") <= radius) & (first_equal_block("_apart", radius) == F.col("_block")))
    # the items' n-grams, which are long, only now; items that repeat an id and agree in all of these are each other's finds
    whole = sent(item_grams.withColumnsRenamed({"item_id": "_item", "_n": "_wn", "_k": "_wk", "_item_print": "_whole_print"}))
    near = near.join(whole, F.col("item_id").eqNullSafe(F.col("_item")) & (F.col("_in") == F.col("_wn")) & (F.col("_ik") == F.col("_wk")) & (F.col("_item_print") == F.col("_whole_print")))
    near = near.withColumn("_shared", overlap("_window", "_grams"))
    near = near.withColumn("similarity", F.expr("_shared / (size(_window) + size(_grams) - _shared)")).where(F.col("similarity") >= F.lit(least - 1e-12))
    best = F.max_by(F.struct("_at", "_n"), F.struct("similarity", -F.col("_at"))).alias("_best")
    pairs = near.groupBy("doc_id", "_key", "item_id").agg(F.max("similarity").alias("similarity"), best)
    return pairs.select("doc_id", "item_id", "similarity", F.col("_best._at").alias("start"), F.col("_best._n").alias("n_words"), "_key")


def remove_contaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that hold no item, columns as they are."""


    def contaminated() -> DataFrame:
        pairs = find_items(docs, items, id_column=id_column, text_column=text_column, **how)
        return stored(pairs.select(F.col("doc_id").alias("_id"), F.col("_key").alias("_hash")).distinct(), "contaminated")

    found = only_last(docs.sparkSession, contaminated)
    rows = docs.withColumn("_text_hash", F.xxhash64(F.coalesce(text_column, F.lit(""))))
    few = sent(found)
    return rows.join(few, rows[id_column].eqNullSafe(few["_id"]) & (rows["_text_hash"] == few["_hash"]), "left_anti").drop("_text_hash")
