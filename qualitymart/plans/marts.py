"""The reporting marts (V1 to V9) over a star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitymart import schemas as S
from qualitymart.functions import scalars
from qualitymart.functions.scalars import pct
from qualitymart.sources.star import Star

_RELEASE = ["release_sk", "release_name"]


def runs_with(status: str) -> Column:
    return F.count_if(F.col("run_status") == status)


def _runs_with_test(t: Star, how: str, *columns: str) -> DataFrame:
    """Runs with the keys their test leads to. Names are joined only after aggregation."""
    return t["fact_test_run"].join(t["dim_test"].select("test_sk", "squad_sk", *columns), "test_sk", how)


def _named(t: Star, counted: DataFrame, **names: list[str]) -> DataFrame:
    """Replace the keys of aggregated rows by dimension columns; the release must be known."""
    for dimension, columns in names.items():
        key = f"{dimension}_sk"
        how = "inner" if dimension == "release" else "left"
        counted = counted.join(t[f"dim_{dimension}"].select(key, *columns), key, how).drop(key)
    return counted


def _by_name(named: DataFrame, sums: list[str]) -> DataFrame:
    """Rows whose keys lead to the same names become one: a key without a dimension row is like no key."""
    keys = [c for c in named.columns if c not in sums]
    return named.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def v1_qa_health_by_release(t: Star) -> DataFrame:
    """Run counts per status and pass rate over all runs, per release."""
    releases = t["dim_release"].select(*_RELEASE, "release_date", "release_status")
    # Counting before the join keeps the fact out of the join altogether.
    counted = t["fact_test_run"].groupBy("release_sk").agg(
        F.count("*").alias("total_runs"),
        runs_with("PASS").alias("passed"),
        runs_with("FAIL").alias("failed"),
        runs_with("BLOCKED").alias("blocked"),
        runs_with("EXECUTING").alias("executing"),
        runs_with("TODO").alias("todo"),
        runs_with("ABORTED").alias("aborted"),
        F.count_if("is_automated").alias("automated_runs"),
    )
    return (
        counted.join(releases, "release_sk")
        .withColumn("pass_rate_pct", pct(F.col("passed"), F.col("total_runs")))
        .drop("release_sk")
    )


def v2_defect_density(t: Star) -> DataFrame:
    """Linked defects per release, squad and defect attributes."""
    defects = t["dim_defect"].select(
        "defect_sk", "severity", "priority", F.col("status").alias("defect_status"), "squad_sk", "critical_flag"
    )
    counted = (
        t["fact_defect_link"]
        .join(defects, "defect_sk", "left")
        .groupBy("release_sk", "squad_sk", "severity", "priority", "defect_status")
        .agg(
            F.count_distinct("defect_key").alias("total_defects"),
            F.count_if("open_flag").alias("open_defects"),
            F.count_if("critical_flag").alias("critical_defects"),
            F.count_distinct("test_run_id").alias("impacted_runs"),
        )
    )
    return _named(t, counted, release=["release_name"], squad=["squad_name"])


def v2b_defects_by_squad(t: Star) -> DataFrame:
    """Older density mart: defects per squad.

    That mart repeats these numbers unchanged for every release so that a slicer can pick one.
    The repetition is left to the page (``with_release``); no cross join is made.
    """
    status, severity = F.col("status"), F.col("severity")
    distinct_when = lambda p: F.count_distinct(F.when(p, F.col("defect_sk")))
    return (
        t["dim_defect"]
        .join(t["dim_squad"].select("squad_sk", "squad_name"), "squad_sk")
        .groupBy("squad_name")
        .agg(
            F.count_distinct("defect_sk").alias("total_defects"),
            distinct_when(status.isin(*S.RESOLVED_STATUSES)).alias("resolved_defects"),
            distinct_when(~status.isin(*S.RESOLVED_STATUSES)).alias("open_defects"),
            distinct_when(severity == "Critical").alias("critical_defects"),
            distinct_when(severity == "High").alias("high_defects"),
        )
    )


def with_release(by_squad: DataFrame, release_name: str) -> DataFrame:
    """The older density mart as one release slicer choice shows it."""
    return by_squad.withColumn("release_name", F.lit(release_name))


def v3_requirement_coverage(t: Star) -> DataFrame:
    """Coverage rows with requirement, squad and release attributes."""
    issues = t["dim_issue"].select(
        "issue_sk",
        "issue_key",
        F.col("summary").alias("requirement_summary"),
        "issue_type",
        "priority",
        F.col("critical_flag").alias("is_critical_requirement"),
        "business_area",
        "squad_sk",
    )
    return (
        t["fact_requirement_coverage"]
        .join(issues, "issue_sk")
        .join(t["dim_release"].select(*_RELEASE), "release_sk")
        .join(t["dim_squad"].select("squad_sk", "squad_name"), "squad_sk", "left")
        .select(
            "issue_key",
            "requirement_summary",
            "issue_type",
            "priority",
            "is_critical_requirement",
            "business_area",
            "squad_name",
            "release_name",
            "total_test_count",
            "passing_test_count",
            "failing_test_count",
            "blocked_test_count",
            "todo_test_count",
            "no_coverage_count",
            "coverage_status",
            "is_covered",
            "partial_coverage_flag",
            "failed_coverage_flag",
        )
    )


def v4_execution_trend(t: Star) -> DataFrame:
    """Runs per day, squad, environment and release; runs without a known test drop out. The day's key is that of
    the calendar, NULL for a day it lacks."""
    counted = (
        _runs_with_test(t, "inner")
        .groupBy(F.to_date("started_at").alias("run_date"), "date_sk", "squad_sk", "environment_sk", "release_sk")
        .agg(
            F.count("*").alias("total_runs"),
            runs_with("PASS").alias("passed"),
            runs_with("FAIL").alias("failed"),
            runs_with("BLOCKED").alias("blocked"),
            F.count_if("is_automated").alias("automated_runs"),
            F.sum("duration_s").alias("_duration"),
            F.count("duration_s").alias("_timed"),
        )
    )
    days = t["dim_date"].select(F.col("date_sk").alias("_day"), "year", "month", "week_of_year")
    named = _named(t, counted, release=["release_name"], squad=["squad_name"], environment=["environment_name"])
    dated = named.join(days, F.col("date_sk") == F.col("_day"), "left").drop("date_sk").withColumnRenamed("_day", "date_sk")
    sums = ["total_runs", "passed", "failed", "blocked", "automated_runs", "_duration", "_timed"]
    average = F.col("_duration") / F.nullif(F.col("_timed"), F.lit(0))
    return _by_name(dated, sums).withColumn("avg_duration_s", average).drop("_duration", "_timed")


def v5_test_type_breakdown(t: Star) -> DataFrame:
    """Runs per test type, squad and release."""
    counted = (
        _runs_with_test(t, "inner", "test_type_sk")
        .groupBy("test_type_sk", "squad_sk", "release_sk")
        .agg(
            F.count("*").alias("total_runs"),
            runs_with("PASS").alias("passed"),
            runs_with("FAIL").alias("failed"),
            runs_with("BLOCKED").alias("blocked"),
        )
    )
    named = _named(t, counted, release=["release_name"], squad=["squad_name"], test_type=["test_type_name"])
    rows = _by_name(named, ["total_runs", "passed", "failed", "blocked"])
    return rows.withColumn("pass_rate_pct", pct(F.col("passed"), F.col("total_runs")))


def v6_test_run_detail(t: Star) -> DataFrame:
    """One denormalised row per run and release."""
    tests = t["dim_test"].select("test_sk", "test_key", F.col("summary").alias("test_summary"), "test_type_sk", "squad_sk")
    executions = t["dim_test_execution"].select(
        "execution_sk", "execution_key", F.col("summary").alias("execution_summary"), "revision"
    )
    return (
        t["fact_test_run"]
        .join(t["dim_release"].select(*_RELEASE, "release_status"), "release_sk")
        .join(tests, "test_sk", "left")
        .join(t["dim_test_type"].select("test_type_sk", "test_type_name"), "test_type_sk", "left")
        .join(executions, "execution_sk", "left")
        .join(t["dim_squad"].select("squad_sk", "squad_name"), "squad_sk", "left")
        .join(
            t["dim_environment"].select("environment_sk", "environment_name", "environment_type"),
            "environment_sk",
            "left",
        )
        .join(t["dim_tester"].select("tester_sk", "tester_name", "team_name"), "tester_sk", "left")
        .join(t["dim_status"].select("status_sk", "status_category"), "status_sk", "left")
        .join(
            t["dim_root_cause"].select("root_cause_sk", "root_cause_name", "root_cause_category"),
            "root_cause_sk",
            "left",
        )
        .select(
            "test_run_id",
            "test_key",
            "test_summary",
            "test_type_name",
            "execution_key",
            "execution_summary",
            "revision",
            "environment_name",
            "environment_type",
            "release_name",
            "release_status",
            "squad_name",
            "run_status",
            "status_category",
            "run_sequence",
            "is_automated",
            "is_blocked",
            "block_reason",
            "started_at",
            "finished_at",
            "duration_s",
            "tester_name",
            "team_name",
            "executed_by",
            "comment",
            "defect_count",
            "root_cause_name",
            "root_cause_category",
        )
    )


def v7_environment_health(t: Star) -> DataFrame:
    """Failed and blocked runs per environment, release, squad, root cause and day."""
    counted = (
        _runs_with_test(t, "left")
        .groupBy(
            "environment_sk", "release_sk", "squad_sk", "root_cause_sk", F.to_date("started_at").alias("execution_date")
        )
        .agg(
            F.count("*").alias("total_runs"),
            runs_with("FAIL").alias("failed_runs"),
            runs_with("BLOCKED").alias("blocked_runs"),
            runs_with("PASS").alias("_passed"),
        )
    )
    named = _named(
        t,
        counted,
        release=["release_name"],
        squad=["squad_name"],
        environment=["environment_name", "environment_type", "criticality"],
        root_cause=["root_cause_name", "root_cause_category"],
    )
    rows = _by_name(named, ["total_runs", "failed_runs", "blocked_runs", "_passed"])
    return rows.withColumn("pass_rate_pct", pct(F.col("_passed"), F.col("total_runs"))).drop("_passed")


def v8_release_snapshot(t: Star, strict: bool = False) -> DataFrame:
    """Snapshot rows with their ratios; the denominator is executed, not all, tests.

    The automation ratio divides all automated runs by the executed ones and may pass 100;
    ``strict`` counts only executed automated runs.
    """
    days = t["dim_date"].select(F.col("date_sk").alias("snapshot_date_sk"), F.col("full_date").alias("snapshot_date"), "year", "month")
    automated = F.col("automated_executed" if strict else "automated_executions")
    counts = [
        "total_tests",
        "executed_tests",
        "passed_tests",
        "failed_tests",
        "blocked_tests",
        "not_run_tests",
        "automated_executions",
        "covered_requirements",
        "total_requirements",
        "open_critical_defects",
    ]
    return (
        t["fact_cycle_snapshot"]
        .join(days, "snapshot_date_sk")
        .join(t["dim_release"].select(*_RELEASE, "release_date", "release_status"), "release_sk")
        .join(t["dim_squad"].select("squad_sk", "squad_name"), "squad_sk", "left")
        .select(
            "snapshot_date",
            "year",
            "month",
            "release_name",
            "release_date",
            "release_status",
            "squad_name",
            *counts,
            "avg_duration_s",
            pct(F.col("passed_tests"), F.col("executed_tests")).alias("pass_rate_pct"),
            pct(F.col("covered_requirements"), F.col("total_requirements")).alias("coverage_rate_pct"),
            pct(automated, F.col("executed_tests")).alias("automation_rate_pct"),
        )
    )


def _defect_quality(t: Star, strict: bool) -> DataFrame:
    """Defect figures per release. By default sums run over links, so a defect counts once per link."""
    closed_at = F.coalesce("resolved_at", "resolution_date")
    hours = scalars.minute_boundaries_as_hours(F.col("created_at"), closed_at)
    defects = t["dim_defect"].select(
        "defect_sk", F.col("defect_key").alias("_known"), "status", "leakage_flag", "critical_flag", hours.alias("_hours")
    )
    links = t["fact_defect_link"].select("release_sk", "defect_sk")
    # Equal links are counted first: one weighted row per (release, defect) goes into the join.
    weighted = links.groupBy("release_sk", "defect_sk").agg(F.count("*").alias("_links"))
    weight = F.lit(1) if strict else F.col("_links")
    total_when = lambda p: F.sum(F.when(p, weight).otherwise(0))
    return (
        weighted.join(defects, "defect_sk")
        .groupBy("release_sk")
        .agg(
            F.count("*").alias("total_defects"),
            total_when(F.col("status").isin(*S.CLOSED_STATUSES)).alias("resolved_defects"),
            total_when(F.col("status") == "Reopened").alias("reopened_defects"),
            total_when(F.col("leakage_flag")).alias("leakage_defects"),
            total_when(F.col("critical_flag")).alias("critical_defects"),
            (F.sum(F.col("_hours") * weight) / F.nullif(F.sum(F.when(F.col("_hours").isNotNull(), weight)), F.lit(0))).alias(
                "avg_resolution_hours"
            ),
        )
    )


def v9_quality_effectiveness(t: Star, strict: bool = False) -> DataFrame:
    """Governance metrics per release.

    By default a release without coverage or runs still reports one requirement or run, because the
    outer join's empty row is counted, and defect sums run over links. ``strict`` counts real rows
    and distinct defects.
    """
    coverage = t["fact_requirement_coverage"].groupBy("release_sk").agg(
        F.count("*").alias("total_requirements"),
        F.count_if("is_covered").alias("covered_requirements"),
        F.count_if(F.col("total_test_count") == 0).alias("requirements_without_tests"),
    )
    failed = F.col("run_status") == "FAIL"
    runs = t["fact_test_run"].groupBy("release_sk").agg(
        F.count("*").alias("total_runs"),
        F.count_if(failed).alias("failed_runs"),
        F.count_if(failed & (F.coalesce("defect_count", F.lit(0)) == 0)).alias("failed_runs_without_defect"),
    )
    joined = (
        t["dim_release"]
        .select(*_RELEASE)
        .join(_defect_quality(t, strict), "release_sk", "left")
        .join(coverage, "release_sk", "left")
        .join(runs, "release_sk", "left")
    )
    empty_row = 0 if strict else 1
    zero = lambda name, when_empty=0: F.coalesce(F.col(name), F.lit(when_empty)).alias(name)
    counted = joined.select(
        "release_name",
        *[zero(c) for c in ("total_defects", "resolved_defects", "reopened_defects", "leakage_defects", "critical_defects")],
        F.coalesce("avg_resolution_hours", F.lit(0.0)).try_cast("decimal(10,2)").alias("avg_resolution_hours"),
        zero("total_requirements", empty_row),
        zero("covered_requirements"),
        zero("requirements_without_tests"),
        zero("total_runs", empty_row),
        zero("failed_runs"),
        zero("failed_runs_without_defect"),
    )
    c = F.col
    return counted.select(
        "*",
        pct(c("resolved_defects"), c("total_defects")).alias("defect_resolution_rate_pct"),
        pct(c("reopened_defects"), c("resolved_defects")).alias("defect_reopen_rate_pct"),
        pct(c("leakage_defects"), c("total_defects")).alias("defect_leakage_rate_pct"),
        pct(c("total_defects") - c("leakage_defects"), c("total_defects")).alias("defect_removal_efficiency_pct"),
        pct(c("covered_requirements"), c("total_requirements")).alias("requirement_coverage_pct"),
        pct(c("requirements_without_tests"), c("total_requirements")).alias("requirements_without_tests_pct"),
        pct(c("failed_runs_without_defect"), c("failed_runs")).alias("failed_runs_without_defect_pct"),
    )


MARTS = {
    "vw_p1_qa_health_by_release": v1_qa_health_by_release,
    "vw_p2_defect_density": v2_defect_density,
    "vw_p3_requirement_coverage": v3_requirement_coverage,
    "vw_p4_execution_trend": v4_execution_trend,
    "vw_p5_test_type_breakdown": v5_test_type_breakdown,
    "vw_p6_test_run_detail": v6_test_run_detail,
    "vw_p7_environment_health": v7_environment_health,
    "vw_p8_release_snapshot": v8_release_snapshot,
    "vw_qm_quality_effectiveness": v9_quality_effectiveness,
}


def register_views(t: Star) -> None:
    """Make all tables and marts available to SQL."""
    t.register_views()
    for name, mart in MARTS.items():
        mart(t).createOrReplaceTempView(name)
