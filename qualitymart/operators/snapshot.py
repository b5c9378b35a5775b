"""Cycle snapshot per (release, squad) for one day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitymart.functions import scalars
from qualitymart.sources.star import Star

_KEYS = ["release_sk", "squad_sk"]


def _run_counts() -> list[Column]:
    status = F.col("run_status")
    return [
        F.count("*").alias("total_tests"),
        F.count_if(scalars.is_executed(status)).alias("executed_tests"),
        F.count_if(status == "PASS").alias("passed_tests"),
        F.count_if(status == "FAIL").alias("failed_tests"),
        F.count_if(status == "BLOCKED").alias("blocked_tests"),
        F.count_if(status == "TODO").alias("not_run_tests"),
        F.count_if("is_automated").alias("automated_executions"),
        F.count_if(F.col("is_automated") & scalars.is_executed(status)).alias("automated_executed"),
    ]


def run_rollup(runs: DataFrame, tests: DataFrame) -> DataFrame:
    """Run counts and mean duration by (release, squad) (A2)."""
    of_squads = runs.join(tests.select("test_sk", "squad_sk"), "test_sk", "left")
    return of_squads.groupBy(*_KEYS).agg(*_run_counts(), F.avg("duration_s").alias("avg_duration_s"))


def month_state(runs: DataFrame) -> DataFrame:
    """What snapshot and coverage need of a month's runs, per (month, release, test): counts, durations, the last run.

    Parts of different months add up, and a month that changes is counted anew by itself, so a run that goes or moves
    is taken back without a look at other months.
    """
    last = F.max(F.struct("started_at", "test_run_id", "run_status", "date_sk")).alias("last")
    durations = [F.sum("duration_s").alias("duration_sum"), F.count("duration_s").alias("duration_count")]
    return runs.groupBy("month", "release_sk", "test_sk").agg(*_run_counts(), *durations, last)


def latest_of_state(state: DataFrame) -> DataFrame:
    """The last run of each (test, release) over the months of ``month_state``."""
    last = state.where("test_sk IS NOT NULL").groupBy("test_sk", "release_sk").agg(F.max("last").alias("_last"))
    return last.select("test_sk", "release_sk", "_last.run_status", "_last.date_sk")


def _counts_of(parts: DataFrame) -> list[str]:
    return [c for c in parts.columns if c.endswith(("_tests", "_executions", "_executed"))]


def _added_up(parts: DataFrame) -> list[Column]:
    """The counts and the mean duration of rows that are parts of one group."""
    mean = F.try_divide(F.sum("duration_sum"), F.sum("duration_count")).alias("avg_duration_s")
    return [*[F.sum(c).alias(c) for c in _counts_of(parts)], mean]


def rollup_of_state(state: DataFrame, tests: DataFrame) -> DataFrame:
    """``run_rollup`` from the parts of ``month_state``; only these meet the squads."""
    parts = [*_counts_of(state), "duration_sum", "duration_count"]
    of_tests = state.groupBy("release_sk", "test_sk").agg(*[F.sum(c).alias(c) for c in parts])
    of_squads = of_tests.join(tests.select("test_sk", "squad_sk"), "test_sk", "left")
    return of_squads.groupBy(*_KEYS).agg(*_added_up(of_squads))


def run_rollup_of_days(runs: DataFrame, tests: DataFrame, days: list[date]) -> DataFrame:
    """``run_rollup`` for each of ``days`` (as ``snapshot_date``) over the runs started by then, from one read of the runs.

    Runs are counted once per day, release and squad; only these parts are dealt to the snapshot days that include
    them. A run without a start is in none.
    """
    of_squads = runs.join(tests.select("test_sk", "squad_sk"), "test_sk", "left")
    durations = [F.sum("duration_s").alias("duration_sum"), F.count("duration_s").alias("duration_count")]
    daily = of_squads.groupBy(*_KEYS, F.to_date("started_at").alias("_day")).agg(*_run_counts(), *durations)
    include = F.filter(F.array(*map(F.lit, sorted(set(days)))), lambda day: day >= F.col("_day"))
    dealt = daily.withColumn("snapshot_date", F.explode(include))
    return dealt.groupBy(*_KEYS, "snapshot_date").agg(*_added_up(daily))


def open_link_state(links: DataFrame) -> DataFrame:
    """The open links of a month as distinct (release, defect)."""
    return links.where("open_flag").select("month", "release_sk", "defect_sk", "defect_key").distinct()


def coverage_rollup(coverage: DataFrame, issues: DataFrame) -> DataFrame:
    """Covered and total requirements by (release, squad) (A3)."""
    return (
        coverage.join(issues.select("issue_sk", "squad_sk"), "issue_sk")
        .groupBy(*_KEYS)
        .agg(
            F.count_if("is_covered").alias("covered_requirements"),
            F.count("*").alias("total_requirements"),
        )
    )


def open_critical_rollup(links: DataFrame, defects: DataFrame) -> DataFrame:
    """Distinct open critical defects by (release, squad) (A4)."""
    return open_critical_of_state(links.where("open_flag"), defects)


def open_critical_of_state(open_links: DataFrame, defects: DataFrame) -> DataFrame:
    """The same from open links alone, or from the parts of ``open_link_state``."""
    critical = defects.where("critical_flag").select("defect_sk", "squad_sk")
    return (
        open_links.join(critical, "defect_sk")
        .groupBy(*_KEYS)
        .agg(F.count_distinct("defect_key").alias("open_critical_defects"))
    )


def _null_safe_left(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on (release, squad) where a missing squad equals a missing squad."""
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in _KEYS})
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in _KEYS]
    return left.join(renamed, on, "left").drop(*[f"_{k}" for k in _KEYS])


def cycle(t: Star, as_of: date) -> DataFrame:
    """Snapshot rows of the day ``as_of``; none when the calendar lacks that day.

    Only (release, squad) pairs that have runs appear.
    """
    runs = run_rollup(t["fact_test_run"], t["dim_test"])
    return of_day(t, as_of, runs, open_critical_rollup(t["fact_defect_link"], t["dim_defect"]))


def cycle_of_days(t: Star, days: list[date]) -> DataFrame:
    """Snapshot rows of several days at once, from the runs started by each day and today's coverage and defects; none
    for days the calendar lacks. Every fact is read once."""
    runs = run_rollup_of_days(t["fact_test_run"], t["dim_test"], days)
    known = t["dim_date"].select(F.col("full_date").alias("snapshot_date"), F.col("date_sk").alias("snapshot_date_sk"))
    rows = _with_states(t, runs, open_critical_rollup(t["fact_defect_link"], t["dim_defect"]))
    return rows.join(known, "snapshot_date").drop("snapshot_date")


def of_day(t: Star, as_of: date, runs: DataFrame, open_critical: DataFrame) -> DataFrame:
    """The day's rows from counted runs and open critical defects; no fact but the coverage is read."""
    day = int(as_of.strftime("%Y%m%d"))
    known = t["dim_date"].where(F.col("date_sk") == day).agg(F.max("date_sk")).scalar()
    return _with_states(t, runs, open_critical).withColumn("snapshot_date_sk", known).where("snapshot_date_sk IS NOT NULL")


def _with_states(t: Star, runs: DataFrame, open_critical: DataFrame) -> DataFrame:
    rows = _null_safe_left(runs, coverage_rollup(t["fact_requirement_coverage"], t["dim_issue"]))
    rows = _null_safe_left(rows, open_critical)
    return rows.fillna(0, subset=["covered_requirements", "total_requirements", "open_critical_defects"])
