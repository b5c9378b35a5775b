"""Exact distinct counts that add up: bitmaps of integer keys as parts, from which every subtotal is made.

A distinct count can't be summed, so a matrix with totals at every level would count its base rows once per level. A
bitmap per cell and block of 32,768 keys can be united instead: the base rows are read once, and months, cells and
totals are unions of parts. Keys are integers; natural ones get dense numbers first (``coded``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitymart.operators import keys


def coded(rows: DataFrame, key: str, code: str) -> DataFrame:
    """``rows`` with dense numbers for a natural key, which combine into few bitmaps; NULL stays NULL."""
    numbers = keys.number(rows.select(key).where(F.col(key).isNotNull()).distinct(), key, code, 0)
    return rows.join(numbers, key, "left")


def parts(rows: DataFrame, by: Sequence[str], distinct: Mapping[str, Column], counted: Mapping[str, Column] | None = None) -> DataFrame:
    """``*by, measure, block, n, bits``: per cell the bitmaps of the ``distinct`` keys (one row per block of keys) and
    the sums of the ``counted`` numbers (one row without a block). NULL keys aren't counted."""
    none = F.lit(None).cast("bigint")
    entries = [F.struct(F.lit(name).alias("measure"), key.cast("bigint").alias("code"), none.alias("n")) for name, key in distinct.items()]
    entries += [F.struct(F.lit(name).alias("measure"), none.alias("code"), n.cast("bigint").alias("n")) for name, n in (counted or {}).items()]
    each = rows.select(*by, F.explode(F.array(*entries)).alias("_e")).select(*by, "_e.*").where("code IS NOT NULL OR n IS NOT NULL")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("code"))
    # Repeated keys are combined and numbers summed before the shuffle; bitmaps, 4 KB each however few keys they hold, are
    # made only where all keys of a cell and block are, not by every task for itself.
    block = [*by, "measure", "block"]
    once = each.withColumn("block", F.bitmap_bucket_number("code")).groupBy(*block, "code").agg(F.sum("n").alias("n"))
    return once.repartition(*block).groupBy(*block).agg(F.sum("n").alias("n"), bits.alias("bits"))


def totals(cells: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``*by, level, *measures`` for every combination of ``by`` and its totals, from parts alone.

    ``cells`` may hold finer parts than ``by``, such as months: they are united. ``level`` is the number whose bits, the
    first column's highest, tell which columns a total runs over.
    """
    sets = [list(kept) + ["measure", "block"] for n in range(len(by), -1, -1) for kept in combinations(by, n)]
    level = sum((F.grouping(c).cast("int") * (1 << (len(by) - 1 - k)) for k, c in enumerate(by)), F.lit(0))
    # finer parts are united first, so that each total takes a cell's bitmap once
    cells = cells.groupBy(*by, "measure", "block").agg(F.sum("n").alias("n"), F.bitmap_or_agg("bits").alias("bits"))
    united = cells.groupingSets(sets, *by, "measure", "block").agg(F.sum("n").alias("n"), F.bitmap_or_agg("bits").alias("bits"), level.alias("level"))
    value = F.when(F.col("block").isNull(), F.col("n")).otherwise(F.bitmap_count("bits"))
    of = lambda name: F.coalesce(F.sum(F.when(F.col("measure") == name, value)), F.lit(0))
    return united.groupBy(*by, "level").agg(*[of(name).alias(name) for name in measures])
