"""Time intelligence and order-dependent operators.

Apart from the run ordinal, everything here works on rows already aggregated by day or month and
uses joins or grouped aggregates, so no step gathers a whole table in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Last row per key by ``order``.

    ``max_by`` combines map-side, so a key that holds a large share of the rows sends one candidate
    per task instead of all its rows to one sort. ``order`` must be unique within a key.
    """
    return _pick(df, keys, order, F.max_by)


def earliest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key by ``order``."""
    return _pick(df, keys, order, F.min_by)


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], by) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def with_prior_month(monthly: DataFrame, month: str, keys: Sequence[str], value: str, when_empty: float | None) -> DataFrame:
    """Add the value of the month before (W2) by an equi-join of the months with themselves.

    ``month`` holds first days of months; a month without rows before it gets ``when_empty``.
    """
    prior = monthly.select(
        F.add_months(month, 1).alias(month), *keys, F.col(value).alias(f"{value}_prior"), F.lit(True).alias("_known")
    )
    on = [F.col(f"m.{c}").eqNullSafe(F.col(f"p.{c}")) for c in [month, *keys]]
    joined = monthly.alias("m").join(prior.alias("p"), on, "left")
    shown = F.when(F.col("p._known"), F.col(f"p.{value}_prior")).otherwise(F.lit(when_empty).cast("double"))
    return joined.select("m.*", shown.alias(f"{value}_prior"))


def month_to_date(daily: DataFrame, day: str, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Running totals within each month (W3); ``daily`` has one row per key and day, so at most 31 per frame."""
    frame = Window.partitionBy(*keys, F.trunc(day, "MONTH")).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("*", *[F.sum(c).over(frame).alias(f"{c}_mtd") for c in columns])


def trailing(daily: DataFrame, day: str, days: int, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Totals over the ``days`` days ending at each day that has rows.

    Every daily row adds to the windows it lies in: a fan-out of ``days`` small rows and one
    aggregation with map-side combine, instead of a single ordered window over all days.
    """
    reach = F.explode(F.sequence(F.col(day), F.date_add(day, days - 1), F.expr("interval 1 day")))
    spread = daily.withColumn("_own", F.col(day)).withColumn(day, reach)
    summed = spread.groupBy(day, *keys).agg(
        *[F.sum(c).alias(f"{c}_trailing") for c in columns],
        F.bool_or(F.col("_own") == F.col(day)).alias("_has_rows"),
    )
    return summed.where("_has_rows").drop("_has_rows")


def share_of_total(counted: DataFrame, value: str, share: str, within: Sequence[str] = ()) -> DataFrame:
    """Share of each row in its total (W6), for rows already aggregated to a few categories."""
    total = F.sum(value).over(Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0)))
    return counted.withColumn(share, F.col(value) / total)


def run_sequence(runs: DataFrame, keys: Sequence[str], started: str, order: Sequence[str | Column]) -> DataFrame:
    """Ordinal of a run among the runs of the same keys (W5), by start time then ``order``.

    One key, or one day of it, may hold a large share of the rows. Rows are numbered within (key, minute);
    minutes get offsets from the counts of earlier minutes of their day, days from those of earlier days. So
    no task orders more rows than a key has in a minute, and the offsets are made from counts alone.
    """
    timed = runs.withColumns({"_day": F.to_date(started), "_minute": F.date_trunc("MINUTE", F.col(started))})
    counts = timed.groupBy(*keys, "_day", "_minute").agg(F.count("*").alias("_n"))
    before = lambda by, order: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    minutes = counts.withColumn("_in_day", F.coalesce(F.sum("_n").over(before([*keys, "_day"], "_minute")), F.lit(0))).drop("_n")
    days = counts.groupBy(*keys, "_day").agg(F.sum("_n").alias("_n"))
    days = days.withColumn("_before", F.coalesce(F.sum("_n").over(before(keys, "_day")), F.lit(0))).drop("_n")
    numbered = timed.withColumn("_within", F.row_number().over(Window.partitionBy(*keys, "_minute").orderBy(started, *order)))
    same = lambda left, right, on: [left[c].eqNullSafe(right[c]) for c in on]
    shifted = numbered.join(minutes, same(numbered, minutes, [*keys, "_day", "_minute"]), "left").select(numbered["*"], "_in_day")
    shifted = shifted.join(days, same(shifted, days, [*keys, "_day"]), "left").select(shifted["*"], "_before")
    ordinal = F.col("_before") + F.col("_in_day") + F.col("_within")
    return shifted.withColumn("run_sequence", ordinal).drop("_day", "_minute", "_within", "_in_day", "_before")
