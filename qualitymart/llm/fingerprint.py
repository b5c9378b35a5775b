"""Homomorphic multiset fingerprints of documents.

A paragraph is hashed to a wide vector, and a document's fingerprint is the sum of its paragraphs'
vectors, lanes for equality modulo 2^32. So the order of paragraphs doesn't matter, and a paragraph is inserted or
deleted by adding or subtracting its vector, without the rest of the text. The vector has two parts:

* ``EQUAL`` lanes with uniform hashes of the whole paragraph: documents with the same paragraphs agree in
  them, others don't.
* ``NEAR`` lanes that sum, over the paragraph's sentences, the sentence's weight where one bit of its hash is
  set. The distance between two documents in these lanes estimates how much of their sentences differs.

DataFrame functions only; a fingerprint is computed within its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualitymart.llm.common import partitions

EQUAL, NEAR = 8, 128
#: Two lanes of 32 bits share a long while sums are formed.
PAIRS = NEAR // 2
#: Rows are cut into ranges by about this many sampled positions for each.
SAMPLED = 32


def fingerprint(text: str) -> Column:
    """The fingerprint of a string column as longs: ``EQUAL`` lanes, the sum of weights, ``NEAR`` / 2 pairs."""
    seeds = ", ".join(f"xxhash64(p, {k}) & 4294967295" for k in range(EQUAL))
    whole = f"""aggregate(
        transform(split({text}, '\\n'), p -> array({seeds})),
        array_repeat(0L, {EQUAL}), (s, v) -> transform(s, (x, i) -> (x + v[i]) & 4294967295))"""
    weight = "cast(ceil(sqrt(length(s))) as bigint)"
    hashes = ", ".join(f"xxhash64(s, {100 + k})" for k in range(PAIRS // 32))
    parts = f"""aggregate(
        transform(filter(split({text}, '\\n|(?<=[.!?]) '), s -> s != ''), s -> struct({weight} as w, array({hashes}) as h)),
        array_repeat(0L, {PAIRS + 1}),
        (s, v) -> transform(s, (x, i) -> x + if(i = 0, v.w, (shiftrightunsigned(v.h[(i - 1) div 32], (i - 1) % 32) & 4294967297L) * v.w)))"""
    return F.expr(f"concat({whole}, {parts})")


def as_text(lanes: str) -> Column:
    """The lanes as hexadecimal digits."""
    return F.expr(f"lower(array_join(transform({lanes}, (x, i) -> lpad(hex(x), if(i < {EQUAL + 1}, 8, 16), '0')), ''))")


def combine(a: str, b: str, sign: int = 1) -> Column:
    """Fingerprint ``a`` with the paragraphs of ``b`` inserted (or with ``sign=-1`` deleted; they must be in it)."""
    how = "+" if sign > 0 else "-"
    return F.expr(f"transform(zip_with({a}, {b}, (x, y) -> x {how} y), (x, i) -> if(i < {EQUAL}, x & 4294967295, x))")


def likeness(a: str, b: str) -> Column:
    """From 0 (no sentence in common, as far as the lanes tell) to 1 (the same sentences).

    With a lane's sum x of weights and the total W, 2x - W is a sum of weights with random signs; its
    square, averaged over lanes, estimates the sum of squared weights.
    """
    signed = "array(2 * ({x} & 4294967295) - {w}, 2 * shiftrightunsigned({x}, 32) - {w})"
    lanes = "flatten(transform(slice({v}, " + str(EQUAL + 2) + ", " + str(PAIRS) + "), x -> " + signed.format(x="x", w="{v}[" + str(EQUAL) + "]") + "))"
    va, vb = lanes.format(v=a), lanes.format(v=b)
    square = "aggregate({v}, 0d, (s, x) -> s + cast(x as double) * x)"
    apart = f"aggregate(zip_with({va}, {vb}, (x, y) -> cast(x - y as double)), 0d, (s, x) -> s + x * x)"
    both = f"({square.format(v=va)} + {square.format(v=vb)})"
    return F.when(F.expr(f"{a} = {b}"), 1.0).otherwise(F.expr(f"greatest(0d, least(1d, 1 - {apart} / nullif({both}, 0d)))"))


def position(id_column: str, tie: str) -> Column:
    """Where a row stands in ascending order of id, null ids first, and of ``tie`` among equal ids."""
    known = F.col(id_column).isNotNull().cast("int")
    return F.struct(known.alias("k"), F.coalesce(F.col(id_column).cast("long"), F.lit(0)).alias("i"), F.col(tie).alias("t"))


def cuts(rows: DataFrame, id_column: str, tie: str, ranges: int) -> list[tuple[int, int, int]]:
    """``ranges`` - 1 sorted positions that part the rows into about equal ranges, from a sample of about ``SAMPLED``
    positions a range. They decide where a row is worked on, not what becomes of it."""
    share = min(1.0, SAMPLED * ranges / max(rows.count(), 1))
    sample = rows.select(position(id_column, tie).alias("p")).select("p.*").sample(share, seed=1).toArrow()
    found = sorted(zip(*(column.to_pylist() for column in sample.columns), strict=True)) or [(0, 0, 0)]
    return [found[k * len(found) // ranges] for k in range(1, ranges)]


def range_of(bounds: list[tuple[int, int, int]], place: Column) -> Column:
    """How many of the sorted ``bounds`` (one fewer than a power of two) are below ``place``, by bisection."""
    steps = F.array(*(F.lit((len(bounds) + 1) >> k) for k in range(1, (len(bounds) + 1).bit_length())))
    table = F.expr("array(" + ", ".join(f"named_struct('k', {k}, 'i', bigint('{i}'), 't', bigint('{t}'))" for k, i, t in bounds) + ")")
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(table, at + step - 1) < place, at + step).otherwise(at))


def with_next(rows: DataFrame, id_column: str, tie: str, take: list[str], derived: dict[str, Column]) -> DataFrame:
    """Each row with the columns ``derived``, and the columns ``take`` of the next one (as ``next_*``) in descending
    order of id and ``tie``, after the last the first.

    Rows are cut at quantiles of (id, tie) into four ranges per shuffle task or more, each ordered by itself, so rows
    without an id, or that share one, spread out as well. The first row of a range is also copied to the end of the
    range before it. Only the position of one row per range goes to all tasks. ``derived`` is computed once a row.
    """
    ranges = 1 << (4 * partitions(rows.sparkSession)).bit_length()
    place = position(id_column, tie)
    dealt = rows.withColumn("_range", range_of(cuts(rows, id_column, tie, ranges), place))
    heads = dealt.groupBy("_range").agg(F.max(place).alias("_head"))
    upward = Window.orderBy("_range")
    everything = upward.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.withColumn("_before", F.coalesce(F.lead("_range").over(upward), F.min("_range").over(everything)))
    same = (dealt["_range"] == heads["_range"]) & (place == heads["_head"])
    first = dealt.join(F.broadcast(heads), same).select(heads["_before"].alias("_range"), *(dealt[c] for c in rows.columns))
    first = first.dropDuplicates(["_range"])
    all_rows = dealt.withColumn("_copy", F.lit(0)).unionByName(first.withColumn("_copy", F.lit(1))).withColumns(derived)
    order = Window.partitionBy("_range").orderBy("_copy", F.col(id_column).desc_nulls_last(), F.col(tie).desc())
    found = all_rows.withColumns({f"next_{c}": F.lead(c).over(order) for c in take})
    return found.where("_copy = 0").drop("_copy", "_range")


def texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("_text"))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, _text, lanes`` of every row; a null text counts as empty, which has one empty paragraph."""
    return texts(docs, id_column, text_column).withColumn("lanes", fingerprint("_text"))


def edit_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every text and of an edited copy, with their likeness.

    The edited text has the last half of the characters replaced by the first as many of the next document
    in descending order of id. Null texts are empty, null ids come last, rows that repeat an id are ordered
    by a hash of their text. A single row is its own next. An empty table gives no rows.
    """
    rows = texts(docs, id_column, text_column).withColumn("_tie", F.xxhash64("_text"))
    rows = with_next(rows, "doc_id", "_tie", ["_text", "lanes"], {"lanes": fingerprint("_text")})
    rows = rows.withColumn("n_chars", F.char_length("_text").cast("long"))
    half = F.expr("cast(n_chars div 2 as int)")
    edited = F.concat(F.expr("substring(_text, 1, cast(n_chars - n_chars div 2 as int))"), F.substring("next__text", F.lit(1), half))
    rows = rows.withColumn("_edited", edited)
    rows = rows.select("doc_id", "n_chars", F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"), "lanes", "next_lanes", fingerprint("_edited").alias("edited_lanes"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text("lanes").alias("fingerprint"),
        as_text("edited_lanes").alias("edited_fingerprint"),
        likeness("lanes", "edited_lanes").alias("near_edited"),
        likeness("lanes", "next_lanes").alias("near_next"),
    )
