"""Page queries (G1 to G18): the result sets behind each report page.

Every function takes the star in its filter context (``context.apply_context``, ``security.secure``)
and returns rows a page shows. Matrices are in long form, one row per cell: no value is lost that nobody
listed, and no extra pass over the data is needed to find the columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualitymart import schemas as S
from qualitymart.functions import measures as M
from qualitymart.functions import scalars
from qualitymart.operators import windows
from qualitymart.plans import marts
from qualitymart.plans.context import with_dims
from qualitymart.sources.star import Star

RELEASE = {"dim_release": ["release_name"]}
SQUAD = {"dim_squad": ["squad_name"]}
TYPE = {"dim_test_type": ["test_type_name"]}
ENVIRONMENT = {"dim_environment": ["environment_name"]}
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def month_of(ts: str) -> Column:
    return F.trunc(F.to_date(ts), "MONTH")


def week_of(day: str | Column) -> Column:
    return F.date_trunc("WEEK", day).cast("date")


def matrix(df: DataFrame, rows: Sequence[str], column: str, cells: dict[str, Column]) -> DataFrame:
    """Cells of rows by columns, one row each, a missing name being a column like any other."""
    return df.groupBy(*rows, column).agg(*[c.alias(n) for n, c in cells.items()])


def wide(df: DataFrame, rows: Sequence[str], column: str, values: Sequence[str], cells: dict[str, Column]) -> DataFrame:
    """Rows by columns for a column whose values are fixed, like weekdays."""
    return df.groupBy(*rows).pivot(column, list(values)).agg(*[c.alias(n) for n, c in cells.items()])


# --- runs by release and month (G1 to G4) -----------------------------------


def runs_by_release_status(t: Star) -> DataFrame:
    runs = with_dims(t, "fact_test_run", {"dim_release": ["release_name", "release_date"]}, "inner")
    return runs.groupBy("release_name", "release_date", "run_status").agg(M.rows().alias("total_runs"))


def monthly_pass_rate(t: Star) -> DataFrame:
    months = t["fact_test_run"].where("started_at IS NOT NULL").groupBy(month_of("started_at").alias("month_start"))
    return months.agg(M.rows().alias("total_runs"), M.pass_rate().alias("pass_rate")).withColumn(
        "target", F.lit(M.PASS_TARGET)
    )


def monthly_change(t: Star) -> DataFrame:
    """Pass rate per month against the month before; no runs before means a rate of zero (M5)."""
    monthly = monthly_pass_rate(t).select("month_start", "pass_rate")
    change = F.col("pass_rate") - F.col("pass_rate_prior")
    return windows.with_prior_month(monthly, "month_start", [], "pass_rate", 0.0).select(
        "month_start",
        "pass_rate",
        "pass_rate_prior",
        change.alias("pass_rate_change"),
        scalars.format_change(change).alias("change_formatted"),
        scalars.format_change_arrow(change).alias("change_arrow"),
    )


def release_summary(t: Star) -> DataFrame:
    runs = t["fact_test_run"].groupBy("release_sk").agg(
        M.rows().alias("total_runs"),
        M.runs_in("PASS").alias("passed_runs"),
        M.runs_in("FAIL").alias("failed_runs"),
        scalars.format_pct(M.pass_rate()).alias("pass_rate_formatted"),
    )
    defects = t["fact_defect_link"].groupBy("release_sk").agg(F.count_distinct("defect_key").alias("_linked"))
    return (
        t["dim_release"]
        .select("release_sk", "release_name", "release_date")
        .join(runs, "release_sk")
        .join(defects, "release_sk", "left")
        .withColumn("defects", F.coalesce("_linked", F.lit(0)))
        .drop("release_sk", "_linked")
    )


def etmi_by_release(t: Star, unfiltered: Star | None = None) -> DataFrame:
    """Test maturity per release.

    Regression automation looks at all tests of type Regression, whatever test or type filter the page
    has: a page with such a filter gives the star without it as ``unfiltered``.
    """
    regression = F.col("test_type_name") == "Regression"
    automation = M.percent(F.count_if(regression & F.col("is_automated")), F.count_if(regression))
    if unfiltered is not None:
        page = etmi_by_release(t).select("release_name", "p1_total_runs", "p1_pass_rate", "automation_coverage", "execution_efficiency")
        every = with_dims(unfiltered, "fact_test_run", {**RELEASE, **TYPE}).groupBy("release_name").agg(automation.alias("regression_automation"))
        return _scored(page.join(every, "release_name"))
    runs = with_dims(t, "fact_test_run", {**RELEASE, **TYPE})
    scored = runs.where("release_name IS NOT NULL").groupBy("release_name").agg(
        M.rows().alias("p1_total_runs"),
        M.pass_rate().alias("p1_pass_rate"),
        M.automation_rate().alias("automation_coverage"),
        automation.alias("regression_automation"),
        M.pass_rate().alias("execution_efficiency"),
    )
    return _scored(scored)


def _scored(scored: DataFrame) -> DataFrame:
    score = M.etmi_score(F.col("automation_coverage"), F.col("regression_automation"), F.col("execution_efficiency"))
    return (
        scored.withColumn("etmi_score", score)
        .withColumn("etmi_band", scalars.band(F.col("etmi_score"), M.ETMI_BANDS, "Emerging"))
        .withColumn("etmi_target", F.lit(M.ETMI_TARGET))
        .withColumn("etmi_status", scalars.status_vs_target(F.col("etmi_score"), M.ETMI_TARGET))
    )


# --- defects (G5, G13) ------------------------------------------------------


def squad_status_matrix(t: Star) -> DataFrame:
    return matrix(marts.v2_defect_density(t), ["squad_name"], "defect_status", {"total_defects": F.sum("total_defects")})


def defects_by(t: Star, *columns: str) -> DataFrame:
    return M.evaluate(marts.v2_defect_density(t), columns, M.p2_measures())


def open_closed_share(t: Star) -> DataFrame:
    counted = t["fact_defect_link"].groupBy("open_flag").agg(M.rows().alias("links"))
    return windows.share_of_total(counted, "links", "share")


def critical_defects(t: Star) -> DataFrame:
    return t["dim_defect"].where("critical_flag").select("defect_key", "summary", "severity", "priority", "status", "assignee")


def defect_detail(t: Star) -> DataFrame:
    columns = ["release_name", "squad_name", "severity", "priority", "defect_status", "open_defects", "critical_defects"]
    return marts.v2_defect_density(t).select(*columns)


def defect_age(t: Star, as_of: Column) -> DataFrame:
    age = M.defect_age_days(as_of)
    return t["dim_defect"].select("defect_key", "priority", "created_at", age.alias("age_days"))


def new_defects_month_to_date(t: Star) -> DataFrame:
    daily = t["dim_defect"].where("created_at IS NOT NULL").groupBy(F.to_date("created_at").alias("day"))
    return windows.month_to_date(daily.agg(M.rows().alias("defects")), "day", [], ["defects"])


# --- coverage (G6, G14) -----------------------------------------------------


def coverage_status_share(t: Star) -> DataFrame:
    counted = t["fact_requirement_coverage"].groupBy("coverage_status").agg(M.rows().alias("requirements"))
    labelled = counted.withColumn("label", scalars.coverage_label(F.col("coverage_status")))
    return windows.share_of_total(labelled, "requirements", "share")


def coverage_matrix(t: Star) -> DataFrame:
    """Coverage percentage per requirement and release."""
    rate = M.coverage_measures("issue_key")["coverage"]
    return matrix(marts.v3_requirement_coverage(t), ["issue_key", "requirement_summary"], "release_name", {"coverage": rate})


def coverage_counts_matrix(t: Star) -> DataFrame:
    cells = {
        "total": F.sum("total_test_count"),
        "passing": F.sum("passing_test_count"),
        "failing": F.sum("failing_test_count"),
        "blocked": F.sum("blocked_test_count"),
    }
    return matrix(marts.v3_requirement_coverage(t), ["issue_key", "requirement_summary"], "release_name", cells)


def uncovered_requirements(t: Star) -> DataFrame:
    """Requirements without a passing test, critical ones first."""
    return (
        marts.v3_requirement_coverage(t)
        .where(~F.col("is_covered"))
        .select("issue_key", "requirement_summary", "priority", "squad_name", "release_name", "is_critical_requirement", "total_test_count")
        .orderBy(F.desc("is_critical_requirement"), F.asc_nulls_last("priority"), "issue_key", "release_name")
    )


def coverage_by_squad(t: Star) -> DataFrame:
    rows = marts.v3_requirement_coverage(t)
    measures = {**M.coverage_measures("issue_key"), "no_coverage": F.sum("no_coverage_count")}
    return M.evaluate(rows, ["squad_name"], measures)


# --- execution trend (G7, G15) ----------------------------------------------


def weekly_combo(t: Star) -> DataFrame:
    runs = t["fact_test_run"].where("started_at IS NOT NULL")
    measures = {
        "passed": M.runs_in("PASS"),
        "failed": M.runs_in("FAIL"),
        "blocked": M.runs_in("BLOCKED"),
        "automation_rate": M.automation_rate(),
        "avg_duration_min": M.avg_duration_min(),
    }
    return M.evaluate(runs, [week_of("started_at").alias("week_start")], measures)


def runs_by_environment(t: Star) -> DataFrame:
    return with_dims(t, "fact_test_run", ENVIRONMENT).groupBy("environment_name", "run_status").agg(M.rows().alias("total_runs"))


def weekly_pass_rate_by_squad(t: Star) -> DataFrame:
    runs = with_dims(t, "fact_test_run", SQUAD).where("started_at IS NOT NULL")
    return M.evaluate(runs, [week_of("started_at").alias("week_start"), "squad_name"], {"pass_rate": M.pass_rate()})


def week_heatmap(t: Star) -> DataFrame:
    """Runs per calendar week and weekday; the columns keep the weekday order (O3)."""
    days = with_dims(t, "fact_test_run", {"dim_date": ["year", "week_of_year", "day_name"]}, "inner")
    return wide(days, ["year", "week_of_year"], "day_name", WEEKDAYS, {"total_runs": M.rows()})


def trailing_runs(t: Star, days: int) -> DataFrame:
    """Runs and passes over the trailing days, with the pass rate of that span."""
    daily = t["fact_test_run"].where("started_at IS NOT NULL").groupBy(F.to_date("started_at").alias("day"))
    counted = daily.agg(M.rows().alias("total_runs"), M.runs_in("PASS").alias("passed"))
    summed = windows.trailing(counted, "day", days, [], ["total_runs", "passed"])
    return summed.withColumn("pass_rate", M.percent(F.col("passed_trailing"), F.col("total_runs_trailing")))


def runs_by_week_of_year(t: Star) -> DataFrame:
    return M.evaluate(marts.v4_execution_trend(t), ["week_of_year"], M.p4_measures())


def trend_by_release(t: Star) -> DataFrame:
    return M.evaluate(marts.v4_execution_trend(t), ["release_name"], M.p4_measures())


def trend_detail(t: Star) -> DataFrame:
    return marts.v4_execution_trend(t).select(
        "run_date", "squad_name", "environment_name", "release_name", "total_runs", "passed", "failed", "avg_duration_s"
    )


# --- test types (G8, G16) ---------------------------------------------------


def type_share(t: Star) -> DataFrame:
    counted = with_dims(t, "fact_test_run", TYPE).groupBy("test_type_name").agg(M.rows().alias("total_runs"))
    return windows.share_of_total(counted, "total_runs", "share")


def type_measures(t: Star) -> DataFrame:
    return M.evaluate(marts.v5_test_type_breakdown(t), ["test_type_name"], M.p5_measures())


def automation_by_type(t: Star) -> DataFrame:
    """Automation judged by the test's type instead of the run's flag (M8)."""
    runs = with_dims(t, "fact_test_run", {**RELEASE, **TYPE}, "left")
    return M.evaluate(
        runs, ["release_name"], {"automated_runs": M.automated_by_type(), "automation_ratio": M.automation_ratio()}
    )


def squad_type_matrix(t: Star) -> DataFrame:
    cells = {
        "total": F.sum("total_runs"),
        "passed": F.sum("passed"),
        "failed": F.sum("failed"),
        "blocked": F.sum("blocked"),
    }
    return matrix(marts.v5_test_type_breakdown(t), ["squad_name"], "test_type_name", cells)


def runs_by_release_type(t: Star) -> DataFrame:
    return (
        marts.v5_test_type_breakdown(t).groupBy("release_name", "test_type_name").agg(F.sum("total_runs").alias("total_runs"))
    )


def slowest_tests(t: Star, n: int = 20, by: str = "avg_duration_min") -> DataFrame:
    """Top tests by mean (or maximum) duration; the key breaks ties (O2)."""
    per_test = t["fact_test_run"].groupBy("test_sk").agg(
        M.avg_duration_min().alias("avg_duration_min"),
        M.max_duration_s().alias("max_duration_s"),
        M.rows().alias("total_runs"),
    )
    tests = t["dim_test"].select("test_sk", "test_key", "summary", "test_type_sk")
    named = per_test.join(tests, "test_sk").join(t["dim_test_type"].select("test_type_sk", "test_type_name"), "test_type_sk", "left")
    return (
        named.orderBy(F.desc_nulls_last(by), "test_key")
        .limit(n)
        .select("test_key", "summary", "test_type_name", "avg_duration_min", "max_duration_s", "total_runs")
    )


# --- drill-through (G9, G17) ------------------------------------------------


def run_detail(t: Star) -> DataFrame:
    return marts.v6_test_run_detail(t)


def status_share(t: Star) -> DataFrame:
    counted = t["fact_test_run"].groupBy("run_status").agg(M.rows().alias("total_runs"))
    ordered = counted.join(t["dim_status"].select(F.col("status_name").alias("run_status"), "sort_order"), "run_status", "left")
    shown = windows.share_of_total(ordered, "total_runs", "share")
    # a few statuses: the place that the page shows each at (O1)
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("sort_order"), "run_status"))
    return shown.withColumn("position", place).orderBy("position")


def steps_of_runs(t: Star) -> DataFrame:
    """Steps of the runs in context."""
    runs = t["fact_test_run"].select("test_run_id").distinct()
    steps = t["fact_test_step_result"].select("test_run_id", "step_order", "step_status", "comment")
    return steps.join(runs, "test_run_id", "left_semi")


# --- environments (G10, G18) ------------------------------------------------


def environment_scorecard(t: Star) -> DataFrame:
    """Pass rate per environment and squad with its colour band."""
    runs = with_dims(t, "fact_test_run", {**ENVIRONMENT, **SQUAD})
    scored = M.evaluate(runs, ["environment_name", "squad_name"], {"total_runs": M.rows(), "pass_rate": M.pass_rate()})
    return scored.withColumn("band", scalars.band(F.col("pass_rate"), M.ENVIRONMENT_BANDS, "Red"))


def environment_matrix(t: Star) -> DataFrame:
    runs = with_dims(t, "fact_test_run", {**ENVIRONMENT, **SQUAD})
    return matrix(runs, ["environment_name"], "squad_name", {"pass_rate": M.pass_rate()})


def environment_subtotals(t: Star) -> DataFrame:
    """Pass rate for every cell, row, column and the whole matrix, each from base rows."""
    runs = with_dims(t, "fact_test_run", {**ENVIRONMENT, **SQUAD})
    level = F.grouping_id().cast("int").alias("level")
    return runs.cube("environment_name", "squad_name").agg(
        M.rows().alias("total_runs"), M.pass_rate().alias("pass_rate"), level
    )


def blocked_by_week(t: Star) -> DataFrame:
    health = marts.v7_environment_health(t)
    return health.groupBy(week_of("execution_date").alias("week_start"), "environment_name").agg(
        F.sum("blocked_runs").alias("blocked_runs")
    )


def root_cause_by_environment(t: Star) -> DataFrame:
    return (
        marts.v7_environment_health(t)
        .groupBy("root_cause_category", "environment_name")
        .agg(
            F.sum("failed_runs").alias("failed_runs"),
            F.sum(F.col("failed_runs") + F.col("blocked_runs")).alias("troubled_runs"),
        )
    )


def environment_detail(t: Star) -> DataFrame:
    """Environment rows from worst to best."""
    health = marts.v7_environment_health(t)
    keys = ["environment_name", "environment_type", "criticality", "squad_name"]
    shown = M.evaluate(health, keys, M.p7_measures())
    # one row per environment and squad: the place from worst to best (O3)
    place = F.row_number().over(Window.orderBy("p7_pass_rate", *[F.asc_nulls_first(k) for k in keys]))
    return shown.withColumn("position", place).orderBy("position")


def environment_kpis(t: Star) -> DataFrame:
    health = marts.v7_environment_health(t)
    monitored = {"environments_monitored": F.count_distinct("environment_name")}
    return M.evaluate(health, [], {**monitored, **M.p7_measures()})


# --- snapshots (G11, G18) ---------------------------------------------------


def snapshot_trend(t: Star) -> DataFrame:
    return M.evaluate(marts.v8_release_snapshot(t), ["snapshot_date", "release_name"], M.p8_measures())


def latest_snapshot(t: Star) -> DataFrame:
    """Newest snapshot of each release and squad."""
    return windows.latest(marts.v8_release_snapshot(t), ["release_name", "squad_name"], ["snapshot_date"])


def not_run_gauge(t: Star) -> DataFrame:
    return marts.v8_release_snapshot(t).groupBy("snapshot_date").agg(
        F.sum("not_run_tests").alias("not_run_tests"), F.sum("total_tests").alias("total_tests")
    )


def snapshot_composition(t: Star) -> DataFrame:
    columns = ("executed_tests", "failed_tests", "blocked_tests", "not_run_tests")
    return marts.v8_release_snapshot(t).groupBy("release_name").agg(*[F.sum(c).alias(c) for c in columns])


def coverage_automation_by_day(t: Star) -> DataFrame:
    columns = ("covered_requirements", "total_requirements", "automated_executions")
    return marts.v8_release_snapshot(t).groupBy("snapshot_date").agg(*[F.sum(c).alias(c) for c in columns])


def release_readiness(t: Star) -> DataFrame:
    """Readiness index per release and snapshot."""
    facts = with_dims(t, "fact_cycle_snapshot", RELEASE, "inner")
    scored = M.evaluate(facts, ["snapshot_date_sk", "release_name"], M.snapshot_measures())
    index = M.readiness_index(F.col("snapshot_pass_rate"), F.col("snapshot_coverage"), F.col("snapshot_automation_rate"))
    return scored.withColumn("readiness_index", index)


# --- governance (G12) -------------------------------------------------------


def governance_rag(t: Star) -> DataFrame:
    return M.rag_rows(marts.v9_quality_effectiveness(t))


def governance_kpis(t: Star) -> DataFrame:
    return M.evaluate(marts.v9_quality_effectiveness(t), [], M.qm_measures())


def governance_table(t: Star) -> DataFrame:
    return marts.v9_quality_effectiveness(t).select(
        "release_name",
        "total_defects",
        "leakage_defects",
        "total_requirements",
        "requirements_without_tests",
        "failed_runs_without_defect",
        "defect_resolution_rate_pct",
        "defect_reopen_rate_pct",
    )


def defect_density(t: Star) -> DataFrame:
    """Linked defects per requirement and release (M26): two facts meet on the release."""
    defects = t["fact_defect_link"].groupBy("release_sk").agg(F.count_distinct("defect_key").alias("defects"))
    needs = t["fact_requirement_coverage"].groupBy("release_sk").agg(F.count_distinct("issue_sk").alias("requirements"))
    both = t["dim_release"].select("release_sk", "release_name").join(defects, "release_sk", "left").join(needs, "release_sk", "left")
    return both.select(
        "release_name",
        F.coalesce("defects", F.lit(0)).alias("defects"),
        F.coalesce("requirements", F.lit(0)).alias("requirements"),
        scalars.divide(F.col("defects"), F.col("requirements")).alias("defect_density"),
    )


STATUS_COLUMNS = S.RUN_STATUSES
