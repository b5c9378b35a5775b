"""The five merge shapes and the purge (U1 to U5, U7), as DataFrame to DataFrame functions.

``updates`` must hold one row per key (``windows.latest``, ``last_known``). The target is the large
side: it is only ever the streamed side of a join or scanned for its keys, so with a small batch
Spark broadcasts the updates and the target is not shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _on(keys: Sequence[str], null_safe: bool) -> list[Column]:
    same = (lambda k: F.col(f"t.{k}").eqNullSafe(F.col(f"u.{k}"))) if null_safe else (lambda k: F.col(f"t.{k}") == F.col(f"u.{k}"))
    return [same(k) for k in keys]


def absent(updates: DataFrame, target: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Updates whose key the target lacks."""
    held = target.select(*keys).alias("t").join(updates.select(*keys).alias("u"), _on(keys, null_safe), "left_semi")
    return updates.alias("u").join(held.alias("t"), _on(keys, null_safe), "left_anti")


def merge(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    overwrite: Sequence[str] = (),
    patch: Sequence[str] = (),
    rules: dict[str, Column] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Merge updates into the target.

    On a match ``overwrite`` columns take the new value, ``patch`` columns take it unless it is NULL,
    ``rules`` compute a column from the ``t.`` and ``u.`` sides, and all others keep the old value. An
    unmatched update is inserted; columns it lacks are NULL.
    """
    rules = rules or {}
    flagged = updates.withColumn("_hit", F.lit(True)).alias("u")
    joined = target.alias("t").join(flagged, _on(keys, null_safe), "left")

    def value(c: str) -> Column:
        old, new = F.col(f"t.{c}"), F.col(f"u.{c}") if c in updates.columns else None
        if c in rules:
            return F.when(F.col("u._hit"), rules[c]).otherwise(old)
        if c in patch:
            return F.coalesce(new, old)
        if c in overwrite:
            return F.when(F.col("u._hit"), new).otherwise(old)
        return old

    kept = joined.select(*[value(c).alias(c) for c in target.columns])
    return kept.unionByName(absent(updates, target, keys, null_safe), allowMissingColumns=True).select(*target.columns)


def overwrite(target: DataFrame, updates: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """A match takes all columns the updates have."""
    columns = [c for c in updates.columns if c not in keys]
    return merge(target, updates, keys, overwrite=columns, null_safe=null_safe)


def replace_rows(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """U1 for facts without generated columns: old rows of the keys go, the updates come."""
    return target.join(updates.select(*keys).distinct(), list(keys), "left_anti").unionByName(updates, allowMissingColumns=True)


def insert_absent(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only keys the target lacks are added; nothing is changed."""
    return target.unionByName(absent(updates, target, keys), allowMissingColumns=True).select(*target.columns)


def patch(target: DataFrame, updates: DataFrame, keys: Sequence[str], rules: dict[str, Column] | None = None) -> DataFrame:
    """A match takes the columns that are not NULL in the update."""
    columns = [c for c in updates.columns if c not in keys]
    return merge(target, updates, keys, patch=columns, rules=rules)


def partial(target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """A match takes only the named columns, also when they are NULL."""
    return merge(target, updates, keys, overwrite=columns)


def last_known(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Per key and column the last value that is not NULL, as a row-by-row patch would leave it."""
    columns = [c for c in rows.columns if c not in (*keys, order)]
    known = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns]
    return rows.groupBy(*keys).agg(*known)


def first_and_last(rows: DataFrame, keys: Sequence[str], order: str, first: Sequence[str], last: Sequence[str]) -> DataFrame:
    """Per key the first value of some columns and the last of others."""
    return (
        rows.groupBy(*keys)
        .agg(
            F.min_by(F.struct(*first), order).alias("_first"),
            F.max_by(F.struct(*last), order).alias("_last"),
        )
        .select(*keys, "_first.*", "_last.*")
    )


def changes(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many updates insert and how many update, as one row."""
    held = target.select(*keys).join(updates.select(*keys), list(keys), "left_semi").withColumn("_held", F.lit(True))
    return updates.join(held, list(keys), "left").agg(
        F.count_if(F.col("_held").isNull()).alias("inserted"), F.count_if("_held").alias("updated")
    )


def purge_project(df: DataFrame, key_column: str, project: str) -> DataFrame:
    """Rows that do not belong to the project named by their key's prefix; NULL keys stay."""
    belongs = F.coalesce(F.substring_index(key_column, "-", 1) == project, F.lit(False))
    return df.where(~belongs)
