"""Surrogate keys: known natural keys keep theirs, new ones get the next free numbers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualitymart.session import dealt


def number(new_keys: DataFrame, key: str, sk: str, start: int, buckets: int | None = None) -> DataFrame:
    """Dense numbers after ``start`` for distinct natural keys.

    Keys are numbered inside hash buckets and shifted by the sizes of the buckets before, so no task
    sees more than a bucket; there are as many as the session has shuffle partitions. The numbers depend
    only on the set of keys, which makes a recomputed task give the same ones.
    """
    buckets = buckets or int(new_keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = new_keys.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    sizes = spread.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # At most ``buckets`` rows from here on: safe to order in one task and to broadcast.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        spread.withColumn("_within", within)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(sk, (F.lit(start) + F.col("_offset") + F.col("_within")).cast("bigint"))
        .drop("_bucket", "_within", "_offset")
    )


def merge_dimension(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    sk: str,
    merge: Callable[[DataFrame, DataFrame, list[str]], DataFrame],
    highest: int | None = None,
    many: bool = False,
) -> DataFrame:
    """Merge updates by natural key; only keys the target lacks are numbered.

    Keys are told apart first: updates of known keys are merged into the target, the others get their
    number among themselves and then pass through the same merge against an empty target. ``highest`` is the last
    number given, needed if ``target`` is only a part of the dimension. ``many`` updates are dealt out by key.
    """
    named = dealt(updates.where(F.col(key).isNotNull() & (F.col(key) != "")), many)
    known = target.select(F.col(key).alias("_known"))
    fresh = dealt(named.join(known, F.col(key) == F.col("_known"), "left_anti"), many)
    if highest is None:
        highest = target.agg(F.coalesce(F.max(sk), F.lit(0)).alias("m")).first()["m"]
    numbers = dealt(number(fresh.select(key), key, sk, highest), many)
    held = dealt(named.join(known, F.col(key) == F.col("_known"), "left_semi"), many)
    merged = merge(target, held, [key])
    inserted = merge(target.where(F.lit(False)), fresh, [key]).drop(sk).join(numbers, key)
    return merged.unionByName(inserted.select(*merged.columns))


def lookup(df: DataFrame, dimension: DataFrame, on: str, key: str, *columns: str, grows: bool = False) -> DataFrame:
    """Attach columns of a dimension by natural key; NULL, empty and unknown keys get NULL.

    Left to Spark whether to broadcast a dimension whose size it knows; one that grows with the facts (``grows``) is dealt
    out by key with them, and adaptive execution splits a key that many rows share.
    """
    found = dimension.select(F.col(key).alias("_key"), *columns)
    found = found.hint("shuffle_hash") if grows else found
    return df.join(found, F.col(on) == F.col("_key"), "left").drop("_key")


def respelled(rows: DataFrame, column: str, order: str | Column, dimension: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """Natural keys that differ only in case take one spelling: the dimension's, if it has the key, else the first by ``order``.

    After this, keys that are equal but for case are equal, so merging, numbering, grouping and lookups need no further
    care. One spelling per key is found by an aggregate, which is combined before the shuffle.
    """
    folded = lambda c: F.collate(c, "UTF8_LCASE")
    first = rows.where(F.col(column).isNotNull()).groupBy(folded(F.col(column)).alias("_folded")).agg(F.min_by(column, order).alias("_spelled"))
    if dimension is not None:
        known = dimension.select(F.col(key or column).alias("_known")).where(F.col("_known").isNotNull())
        first = first.join(known, F.col("_folded") == folded(F.col("_known")), "left").withColumn("_spelled", F.coalesce("_known", "_spelled")).drop("_known")
    found = rows.join(first, folded(rows[column]) == F.col("_folded"), "left")
    return found.withColumn(column, F.coalesce("_spelled", column)).select(*rows.columns)
