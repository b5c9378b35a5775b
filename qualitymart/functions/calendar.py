"""Calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default range of the calendar.
DEFAULT_START = date(2018, 1, 1)
DEFAULT_END = date(2030, 12, 31)


# All calendar columns of ``full_date`` (C27); the fiscal year is the calendar year.
ATTRIBUTES = (
    "year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS date_sk",
    "full_date",
    "cast(year(full_date) as smallint) AS year",
    "cast(quarter(full_date) as smallint) AS quarter",
    "cast(month(full_date) as smallint) AS month",
    "date_format(full_date, 'MMMM') AS month_name",
    "cast(weekofyear(full_date) as smallint) AS week_of_year",
    "cast(day(full_date) as smallint) AS day_of_month",
    "cast(weekday(full_date) + 1 as smallint) AS day_of_week",
    "date_format(full_date, 'EEEE') AS day_name",
    "weekday(full_date) >= 5 AS is_weekend",
    "cast(year(full_date) as smallint) AS fiscal_year",
    "cast(quarter(full_date) as smallint) AS fiscal_quarter",
)


def days(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day between two date columns; no row where the range is reversed."""
    # The end is raised to the start, since a constant range is evaluated before any filter.
    span = F.sequence(first, F.greatest(first, last), F.expr("interval 1 day"))
    return bounds.select(F.explode(F.when(F.col(first) <= F.col(last), span)).alias("full_date"))


def dim_date(spark: SparkSession, start: date = DEFAULT_START, end: date = DEFAULT_END) -> DataFrame:
    """Calendar rows from ``start`` to ``end`` inclusive."""
    bounds = spark.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("last"))
    return from_bounds(bounds, "first", "last")


def from_bounds(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Calendar rows for a range that is itself computed from data."""
    return days(bounds, first, last).selectExpr(*ATTRIBUTES)


def refresh_names(target: DataFrame, source: DataFrame) -> DataFrame:
    """Merge calendar rows (U6): new days are added, known days only get corrected names."""
    fresh = source.select("date_sk", F.col("month_name").alias("_month"), F.col("day_name").alias("_day"))
    kept = (
        target.join(fresh, "date_sk", "left")
        .withColumn("month_name", F.coalesce("_month", "month_name"))
        .withColumn("day_name", F.coalesce("_day", "day_name"))
        .drop("_month", "_day")
    )
    return kept.unionByName(source.join(target.select("date_sk"), "date_sk", "left_anti"))
