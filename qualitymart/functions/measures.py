"""Reusable measures: aggregate columns to use with ``groupBy(...).agg(...)``.

A measure takes its filter context from the rows it is applied to, so subtotals come from
``rollup``/``cube`` on base rows and never from summing ratios.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitymart import schemas as S
from qualitymart.functions import scalars
from qualitymart.functions.scalars import divide

# Targets and limits.
PASS_TARGET = 80.0
ETMI_TARGET = 75.0
ETMI_BANDS = ((75.0, "Mature"), (50.0, "Developing"))
ENVIRONMENT_BANDS = ((80.0, "Green"), (60.0, "Amber"))


def rows() -> Column:
    return F.count(F.lit(1))


def percent(part: Column, whole: Column) -> Column:
    """Ratio times 100, zero over an empty whole."""
    return divide(part, whole) * 100


# --- test runs (M1 to M8) ---------------------------------------------------


def runs_in(status: str) -> Column:
    return F.count_if(F.col("run_status") == status)


def pass_rate() -> Column:
    return percent(runs_in("PASS"), rows())


def avg_duration_s() -> Column:
    return F.avg("duration_s")


def avg_duration_min() -> Column:
    return divide(avg_duration_s(), F.lit(60.0), None)


def total_test_hours() -> Column:
    return divide(F.sum("duration_s"), F.lit(3600.0))


def max_duration_s() -> Column:
    return F.max("duration_s")


def automated_runs() -> Column:
    return F.count_if("is_automated")


def automation_rate() -> Column:
    return percent(automated_runs(), rows())


def automated_by_type() -> Column:
    """Runs whose test has a type other than Manual; a run without a type counts."""
    return F.count_if(F.coalesce(F.col("test_type_name") != "Manual", F.lit(True)))


def automation_ratio() -> Column:
    return percent(automated_by_type(), rows())


def run_measures() -> dict[str, Column]:
    return {
        "total_runs": rows(),
        "passed_runs": runs_in("PASS"),
        "failed_runs": runs_in("FAIL"),
        "blocked_runs": runs_in("BLOCKED"),
        "todo_runs": runs_in("TODO"),
        "executing_runs": runs_in("EXECUTING"),
        "aborted_runs": runs_in("ABORTED"),
        "pass_rate": pass_rate(),
        "pass_rate_formatted": scalars.format_pct(pass_rate()),
        "pass_rate_status": scalars.status_vs_target(pass_rate(), PASS_TARGET),
        "avg_duration_s": avg_duration_s(),
        "avg_duration_min": avg_duration_min(),
        "total_test_hours": total_test_hours(),
        "max_duration_s": max_duration_s(),
        "automated_runs": automated_runs(),
        "automation_rate": automation_rate(),
    }


# --- defects (M9 to M11, M13) -----------------------------------------------


def defect_measures() -> dict[str, Column]:
    status = F.col("status")
    is_open = scalars.is_open_defect(status)
    critical = scalars.critical_defect(F.col("severity"), F.col("priority"))
    return {
        "total_defects": rows(),
        "open_defects": F.count_if(is_open),
        "critical_defects": F.count_if(critical),
        "open_critical_defects": F.count_if(is_open & critical),
        "resolution_rate": percent(F.count_if(status.isin(*S.RESOLVED_STATUSES)), rows()),
    }


def defect_age_days(as_of: Column) -> Column:
    return F.datediff(as_of, F.to_date("created_at"))


def link_measures() -> dict[str, Column]:
    return {
        "total_defect_links": rows(),
        "open_defects_linked": F.count_if("open_flag"),
        "unique_defects": F.count_distinct("defect_key"),
        "impacted_test_runs": F.count_distinct("test_run_id"),
    }


# --- snapshot, coverage (M12, M14, M25, M27) --------------------------------


def snapshot_measures() -> dict[str, Column]:
    total = lambda c: F.sum(c)
    return {
        "snapshot_pass_rate": percent(total("passed_tests"), total("executed_tests")),
        "snapshot_coverage": percent(total("covered_requirements"), total("total_requirements")),
        "snapshot_automation_rate": percent(total("automated_executions"), total("executed_tests")),
        "snapshot_open_critical_defects": total("open_critical_defects"),
    }


def readiness_index(pass_rate: Column, coverage: Column, automation: Column) -> Column:
    """Release readiness: weights 0.40, 0.30 and 0.10, one decimal."""
    return F.round(pass_rate * 0.40 + coverage * 0.30 + automation * 0.10, 1)


def coverage_measures(key: str = "issue_sk") -> dict[str, Column]:
    total = F.count_distinct(key)
    covered = F.count_distinct(F.when(F.col("is_covered"), F.col(key)))
    return {
        "total_requirements": total,
        "covered_requirements": covered,
        "uncovered_requirements": total - covered,
        "coverage": percent(covered, total),
    }


def coverage_status_label() -> Column:
    return scalars.coverage_label(F.max("coverage_status"))


def is_uncovered(passing_test_count: Column) -> Column:
    return F.when(passing_test_count == 0, "Yes").otherwise("No")


# --- measures over marts (M15, M18 to M24) ----------------------------------


def p1_measures() -> dict[str, Column]:
    return {
        "p1_total_runs": F.sum("total_runs"),
        "p1_passed": F.sum("passed"),
        "p1_failed": F.sum("failed"),
        "p1_blocked": F.sum("blocked"),
        "p1_pass_rate": percent(F.sum("passed"), F.sum("total_runs")),
        "p1_automation_rate": percent(F.sum("automated_runs"), F.sum("total_runs")),
    }


def p2_measures() -> dict[str, Column]:
    return {
        "p2_total_defects": F.sum("total_defects"),
        "p2_open_defects": F.sum("open_defects"),
        "p2_critical_defects": F.sum("critical_defects"),
        "p2_impacted_runs": F.sum("impacted_runs"),
    }


def p3_measures() -> dict[str, Column]:
    base = coverage_measures("issue_key")
    return {
        "p3_total_requirements": base["total_requirements"],
        "p3_covered_requirements": base["covered_requirements"],
        "p3_coverage": base["coverage"],
    }


def p4_measures() -> dict[str, Column]:
    return {
        "p4_total_runs": F.sum("total_runs"),
        "p4_passed": F.sum("passed"),
        "p4_failed": F.sum("failed"),
        "p4_avg_duration_s": F.avg("avg_duration_s"),
    }


def p5_measures() -> dict[str, Column]:
    """The pass rate is the plain mean of the rows' rates, as the page shows it."""
    return {
        "p5_total_runs": F.sum("total_runs"),
        "p5_passed": F.sum("passed"),
        "p5_failed": F.sum("failed"),
        "p5_pass_rate": F.avg(F.col("pass_rate_pct").cast("double")),
    }


def p7_measures() -> dict[str, Column]:
    total, failed, blocked = F.sum("total_runs"), F.sum("failed_runs"), F.sum("blocked_runs")
    return {
        "p7_total_runs": total,
        "p7_failed_runs": failed,
        "p7_blocked_runs": blocked,
        "p7_pass_rate": percent(total - failed - blocked, total),
    }


def p8_measures() -> dict[str, Column]:
    return {name.replace("snapshot", "p8"): m for name, m in snapshot_measures().items()}


def qm_measures() -> dict[str, Column]:
    mean = lambda c: F.avg(F.col(c).cast("double"))
    return {
        "qm_defect_leakage_rate": mean("defect_leakage_rate_pct"),
        "qm_defect_removal_efficiency": mean("defect_removal_efficiency_pct"),
        "qm_requirements_without_tests": mean("requirements_without_tests_pct"),
        "qm_failed_runs_without_defect": mean("failed_runs_without_defect_pct"),
        "qm_avg_resolution_hours": mean("avg_resolution_hours"),
    }


# --- execution and test maturity (M16, M17) ---------------------------------


def etmi_score(automation: Column, regression: Column, efficiency: Column) -> Column:
    """Test maturity: 40 parts automation, 30 regression automation, 30 pass rate."""
    return (
        divide(automation, F.lit(100.0)) * 40 + divide(regression, F.lit(100.0)) * 30 + divide(efficiency, F.lit(100.0)) * 30
    )


# --- governance thresholds (M28) --------------------------------------------

# Metric, whether high is good, green limit, red limit. Between them is amber.
RAG_LIMITS = (
    ("defect_resolution_rate_pct", True, 90.0, 75.0),
    ("defect_reopen_rate_pct", False, 8.0, 15.0),
    ("defect_leakage_rate_pct", False, 5.0, 10.0),
    ("defect_removal_efficiency_pct", True, 95.0, 90.0),
    ("requirement_coverage_pct", True, 97.0, 92.0),
    ("requirements_without_tests_pct", False, 3.0, 8.0),
    ("failed_runs_without_defect_pct", False, 5.0, 12.0),
    ("avg_resolution_hours", False, 48.0, 96.0),
)


def rag(value: Column, high_is_good: bool, green: float, red: float) -> Column:
    """Green, Amber or Red; NULL when there is no value."""
    is_green = value >= green if high_is_good else value <= green
    is_red = value < red if high_is_good else value > red
    return F.when(value.isNull(), F.lit(None)).when(is_green, "Green").when(is_red, "Red").otherwise("Amber")


def rag_rows(quality: DataFrame) -> DataFrame:
    """One row per release and governance metric, with its value and colour."""
    entries = [
        F.struct(
            F.lit(metric).alias("metric"),
            F.col(metric).cast("double").alias("value"),
            rag(F.col(metric), high_is_good, green, red).alias("rag"),
        )
        for metric, high_is_good, green, red in RAG_LIMITS
    ]
    return quality.select("release_name", F.explode(F.array(*entries)).alias("e")).select("release_name", "e.*")


def evaluate(df: DataFrame, by: Sequence[str | Column], measures: Mapping[str, Column]) -> DataFrame:
    """Measures for each combination of ``by``; no ``by`` gives the single total row."""
    return df.groupBy(*by).agg(*[m.alias(name) for name, m in measures.items()])
