"""Page queries, security, and filter contexts on the derived star."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from qualitymart.operators import security, snapshot
from qualitymart.plans import marts, pages
from qualitymart.plans.context import Context, apply_context
from qualitymart.queries.marts import SNAPSHOT_DAY
from qualitymart.queries.registry import query

RELEASES = [f"R{year}Q{quarter}" for year in range(1995, 2002) for quarter in range(1, 5)]


def pivot_sql(column: str, values, cell: str, suffix: str = "") -> str:
    """One conditional aggregate per pivot value; ``cell`` holds ``@`` where the condition goes."""
    return ", ".join(f"{cell.replace('@', f'{column} = {v!r}')} AS \"{v}{suffix}\"" for v in values)


def bigsum(expression: str) -> str:
    return f"CAST(sum({expression}) AS BIGINT)"


query(
    "g0_filtered_page",
    """SELECT release_name, squad_name, environment_name, count(*) AS total_runs, count(*) FILTER (run_status = 'PASS') AS passed
       FROM run_squad JOIN dim_program USING (program_sk)
       WHERE release_name LIKE 'R1999%' AND program_name IN ('ASIA', 'EUROPE') AND environment_name IN ('SIT', 'UAT')
             AND date_sk BETWEEN 19990201 AND 19991115 GROUP BY ALL""",
)(
    lambda i: marts.v4_execution_trend(
        apply_context(
            i.t,
            Context(
                releases=tuple(r for r in RELEASES if r.startswith("R1999")),
                programs=("ASIA", "EUROPE"),
                environments=("SIT", "UAT"),
                first_day=date(1999, 2, 1),
                last_day=date(1999, 11, 15),
            ),
        )
    )
    .groupBy("release_name", "squad_name", "environment_name")
    .agg(F.sum("total_runs").alias("total_runs"), F.sum("passed").alias("passed"))
)
query(
    "g1_runs_by_release_status",
    """SELECT f.release_name, release_date, run_status, count(*) AS total_runs FROM fact_test_run f
       JOIN dim_release r ON r.release_name = f.release_name GROUP BY ALL""",
)(lambda i: pages.runs_by_release_status(i.t))
query(
    "g2_monthly_pass_rate",
    """SELECT CAST(date_trunc('month', started_at) AS DATE) AS month_start, count(*) AS total_runs,
              {ratio:count(*) FILTER (run_status = 'PASS'),count(*)} AS pass_rate, 80.0 AS target FROM fact_test_run GROUP BY 1""",
)(lambda i: pages.monthly_pass_rate(i.t))
query(
    "g3_release_summary",
    """SELECT v1.release_name, release_date, total_runs, passed AS passed_runs, failed AS failed_runs,
              CAST(((2000 * passed + total_runs) // (2 * total_runs)) / 10.0 AS DECIMAL(18, 1)) || '%' AS pass_rate_formatted,
              coalesce(d.n, 0) AS defects
       FROM v1 LEFT JOIN (SELECT release_name, count(DISTINCT defect_key) AS n FROM fact_defect_link GROUP BY ALL) d
            ON d.release_name = v1.release_name""",
)(lambda i: pages.release_summary(i.t))
query(
    "g5_squad_status_matrix",
    f"SELECT squad_name, defect_status, {bigsum('total_defects')} AS total_defects FROM v2 GROUP BY squad_name, defect_status",
)(lambda i: pages.squad_status_matrix(i.t))
P2 = ", ".join(
    f"{bigsum(c)} AS p2_{c}" for c in ("total_defects", "open_defects", "critical_defects", "impacted_runs")
)
query("g5_squad_severity", f"SELECT squad_name, severity, {P2} FROM v2 GROUP BY squad_name, severity")(
    lambda i: pages.defects_by(i.t, "squad_name", "severity")
)
query(
    "g5_open_closed_share",
    """SELECT open_flag, count(*) AS links, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share
       FROM fact_defect_link GROUP BY open_flag""",
)(lambda i: pages.open_closed_share(i.t))
query(
    "g5_critical_defects",
    "SELECT defect_key, summary, severity, priority, status, assignee FROM dim_defect WHERE critical_flag",
)(lambda i: pages.critical_defects(i.t))
query(
    "g6_coverage_status_share",
    """SELECT coverage_status, count(*) AS requirements, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share,
              CASE coverage_status WHEN 'PASS' THEN '✓ Covered' WHEN 'FAIL' THEN '✗ Failing' WHEN 'BLOCKED' THEN '⚠ Blocked'
                   WHEN 'TODO' THEN '○ Planned' WHEN 'EXECUTING' THEN '↻ Executing' END AS label
       FROM fact_requirement_coverage GROUP BY coverage_status""",
)(lambda i: pages.coverage_status_share(i.t))
query(
    "g6_requirement_release_matrix",
    """SELECT issue_key, requirement_summary, release_name, max(CASE WHEN is_covered THEN 100.0 ELSE 0.0 END) AS coverage
       FROM v3 GROUP BY issue_key, requirement_summary, release_name""",
)(lambda i: pages.coverage_matrix(i.t))
query(
    "g6_uncovered_requirements",
    """SELECT issue_key, requirement_summary, priority, squad_name, release_name, is_critical_requirement, total_test_count
       FROM v3 WHERE NOT is_covered""",
)(lambda i: pages.uncovered_requirements(i.t))
query(
    "g6_coverage_by_squad",
    f"""SELECT squad_name, count(DISTINCT issue_key) AS total_requirements,
               count(DISTINCT issue_key) FILTER (is_covered) AS covered_requirements,
               total_requirements - covered_requirements AS uncovered_requirements,
               {{ratio:covered_requirements,total_requirements}} AS coverage, {bigsum('no_coverage_count')} AS no_coverage
        FROM v3 GROUP BY squad_name""",
)(lambda i: pages.coverage_by_squad(i.t))
query(
    "g7_weekly_combo",
    """SELECT CAST(date_trunc('week', started_at) AS DATE) AS week_start, count(*) FILTER (run_status = 'PASS') AS passed,
              count(*) FILTER (run_status = 'FAIL') AS failed, count(*) FILTER (run_status = 'BLOCKED') AS blocked,
              {ratio:count(*) FILTER (is_automated),count(*)} AS automation_rate, avg(duration_s) / 60.0 AS avg_duration_min
       FROM fact_test_run GROUP BY 1""",
)(lambda i: pages.weekly_combo(i.t))
query(
    "g7_runs_by_environment",
    "SELECT environment_name, run_status, count(*) AS total_runs FROM fact_test_run GROUP BY ALL",
)(lambda i: pages.runs_by_environment(i.t))
query(
    "g7_weekly_pass_rate_by_squad",
    """SELECT CAST(date_trunc('week', started_at) AS DATE) AS week_start, squad_name,
              {ratio:count(*) FILTER (run_status = 'PASS'),count(*)} AS pass_rate FROM run_squad GROUP BY 1, 2""",
)(lambda i: pages.weekly_pass_rate_by_squad(i.t))
query(
    "g7_week_heatmap",
    f"""SELECT year, week_of_year, {pivot_sql('day_name', pages.WEEKDAYS, 'nullif(count(*) FILTER (@), 0)')}
        FROM fact_test_run JOIN dim_date USING (date_sk) GROUP BY year, week_of_year""",
)(lambda i: pages.week_heatmap(i.t))
query(
    "g8_type_share",
    """SELECT test_type_name, count(*) AS total_runs, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share
       FROM run_squad GROUP BY test_type_name""",
)(lambda i: pages.type_share(i.t))
CELLS = {"total": "total_runs", "passed": "passed", "failed": "failed", "blocked": "blocked"}
query(
    "g8_squad_type_matrix",
    f"SELECT squad_name, test_type_name, {', '.join(f'{bigsum(c)} AS {n}' for n, c in CELLS.items())} FROM v5 GROUP BY squad_name, test_type_name",
)(lambda i: pages.squad_type_matrix(i.t))
SLOWEST = """SELECT test_key, test_summary AS summary, test_type_name, avg(duration_s) / 60.0 AS avg_duration_min,
                    max(duration_s) AS max_duration_s, count(*) AS total_runs
             FROM run_squad GROUP BY ALL ORDER BY @ DESC NULLS LAST, test_key LIMIT 20"""
query("g8_slowest_tests", SLOWEST.replace("@", "avg_duration_min"))(lambda i: pages.slowest_tests(i.t))
query("g8_longest_tests", SLOWEST.replace("@", "max_duration_s"))(
    lambda i: pages.slowest_tests(i.t, by="max_duration_s")
)
DRILL = Context(releases=("R1998Q2",), squads=("NATION_4",), environments=("UAT",))
query(
    "g9_run_detail_drill",
    "SELECT * FROM v6 WHERE release_name = 'R1998Q2' AND squad_name = 'NATION_4' AND environment_name = 'UAT'",
)(lambda i: pages.run_detail(apply_context(i.t, DRILL)))
query(
    "g9_status_distribution",
    """SELECT *, row_number() OVER (ORDER BY sort_order NULLS LAST, run_status) AS position FROM (
           SELECT run_status, sort_order, count(*) AS total_runs, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share
           FROM run_squad JOIN dim_status ON status_name = run_status
           WHERE release_name = 'R1998Q2' AND squad_name = 'NATION_4' AND environment_name = 'UAT' GROUP BY ALL)""",
)(lambda i: pages.status_share(apply_context(i.t, DRILL)))
STEPS = """steps AS (SELECT test_run_id, step_order, comment,
                            CASE WHEN step_order = length(test_run_id) % 3 + 1 THEN run_status ELSE 'PASS' END AS step_status
                     FROM (SELECT test_run_id, run_status, comment, unnest(generate_series(1, length(test_run_id) % 3 + 1)) AS step_order
                           FROM fact_test_run))"""
query(
    "j11_steps_of_runs",
    f"""WITH {STEPS} SELECT test_run_id, CAST(step_order AS INT) AS step_order, step_status, comment FROM steps
        WHERE test_run_id IN (SELECT test_run_id FROM run_squad WHERE release_name = 'R1998Q2' AND squad_name = 'NATION_4'
                                     AND environment_name = 'UAT')""",
)(lambda i: pages.steps_of_runs(apply_context(i.t, DRILL)))
query(
    "g17_drill_by_defect",
    """SELECT * FROM v6 WHERE test_run_id IN (SELECT test_run_id FROM fact_defect_link WHERE defect_key IN ('D-10', 'D-11', 'D-12'))""",
)(lambda i: pages.run_detail(apply_context(i.t, Context(defects=("D-10", "D-11", "D-12")))))
query(
    "g10_environment_scorecard",
    """SELECT environment_name, squad_name, count(*) AS total_runs, {ratio:count(*) FILTER (run_status = 'PASS'),count(*)} AS pass_rate,
              CASE WHEN pass_rate >= 80 THEN 'Green' WHEN pass_rate >= 60 THEN 'Amber' ELSE 'Red' END AS band
       FROM run_squad GROUP BY environment_name, squad_name""",
)(lambda i: pages.environment_scorecard(i.t))
query(
    "g10_environment_matrix",
    """SELECT environment_name, squad_name, {ratio:count(*) FILTER (run_status = 'PASS'),count(*)} AS pass_rate
       FROM run_squad GROUP BY environment_name, squad_name""",
)(lambda i: pages.environment_matrix(i.t))
query(
    "a13_environment_subtotals",
    """SELECT environment_name, squad_name, count(*) AS total_runs, {ratio:count(*) FILTER (run_status = 'PASS'),count(*)} AS pass_rate,
              grouping(environment_name, squad_name) AS level FROM run_squad GROUP BY CUBE (environment_name, squad_name)""",
)(lambda i: pages.environment_subtotals(i.t))
query(
    "g10_blocked_by_week",
    f"""SELECT CAST(date_trunc('week', execution_date) AS DATE) AS week_start, environment_name, {bigsum('blocked_runs')} AS blocked_runs
        FROM v7 GROUP BY 1, 2""",
)(lambda i: pages.blocked_by_week(i.t))
query(
    "g10_root_cause_by_environment",
    f"""SELECT root_cause_category, environment_name, {bigsum('failed_runs')} AS failed_runs,
               {bigsum('failed_runs + blocked_runs')} AS troubled_runs FROM v7 GROUP BY 1, 2""",
)(lambda i: pages.root_cause_by_environment(i.t))
P7 = f"""{bigsum('total_runs')} AS p7_total_runs, {bigsum('failed_runs')} AS p7_failed_runs, {bigsum('blocked_runs')} AS p7_blocked_runs,
         {{ratio:(p7_total_runs - p7_failed_runs - p7_blocked_runs),p7_total_runs}} AS p7_pass_rate"""
query(
    "g10_environment_detail",
    f"""SELECT *, row_number() OVER (ORDER BY p7_pass_rate, environment_name NULLS FIRST, environment_type NULLS FIRST,
                                     criticality NULLS FIRST, squad_name NULLS FIRST) AS position
        FROM (SELECT environment_name, environment_type, criticality, squad_name, {P7} FROM v7 GROUP BY 1, 2, 3, 4)""",
)(lambda i: pages.environment_detail(i.t))
query("g10_environment_kpis", f"SELECT count(DISTINCT environment_name) AS environments_monitored, {P7} FROM v7")(
    lambda i: pages.environment_kpis(i.t)
)

EARLIER_DAY = date(1998, 12, 31)


def two_snapshots(t):
    """Snapshots of two days; the earlier one sees only the runs started by then."""
    return t.replace(fact_cycle_snapshot=snapshot.cycle_of_days(t, [EARLIER_DAY, SNAPSHOT_DAY]))


SNAPSHOTS = """days AS (SELECT unnest([DATE '1998-12-31', DATE '2001-12-31']) AS day),
    snaps AS (SELECT d.day AS snapshot_date, r.release_name, r.squad_name, count(*) AS total_tests,
                     count(*) FILTER (run_status NOT IN ('TODO', 'EXECUTING')) AS executed_tests,
                     count(*) FILTER (run_status = 'PASS') AS passed_tests, count(*) FILTER (run_status = 'FAIL') AS failed_tests,
                     count(*) FILTER (run_status = 'BLOCKED') AS blocked_tests, count(*) FILTER (run_status = 'TODO') AS not_run_tests,
                     count(*) FILTER (is_automated) AS automated_executions, avg(duration_s) AS avg_duration_s
              FROM run_squad r JOIN days d ON CAST(r.started_at AS DATE) <= d.day GROUP BY ALL),
    snapshots AS (SELECT s.*, f.covered_requirements, f.total_requirements, f.open_critical_defects
                  FROM snaps s JOIN fact_cycle_snapshot f ON f.release_name = s.release_name
                       AND f.squad_name IS NOT DISTINCT FROM s.squad_name)"""
query(
    "g11_snapshot_trend",
    f"""WITH {SNAPSHOTS} SELECT snapshot_date, release_name, {{ratio:sum(passed_tests),sum(executed_tests)}} AS p8_pass_rate,
               {{ratio:sum(covered_requirements),sum(total_requirements)}} AS p8_coverage,
               {{ratio:sum(automated_executions),sum(executed_tests)}} AS p8_automation_rate,
               {bigsum('open_critical_defects')} AS p8_open_critical_defects FROM snapshots GROUP BY 1, 2""",
)(lambda i: pages.snapshot_trend(two_snapshots(i.t)))
query(
    "g11_latest_snapshot",
    "SELECT * FROM v8",
)(lambda i: pages.latest_snapshot(two_snapshots(i.t)))
query(
    "g11_not_run_gauge",
    f"""WITH {SNAPSHOTS} SELECT snapshot_date, {bigsum('not_run_tests')} AS not_run_tests, {bigsum('total_tests')} AS total_tests
        FROM snapshots GROUP BY 1""",
)(lambda i: pages.not_run_gauge(two_snapshots(i.t)))
query(
    "g18_snapshot_composition",
    "WITH "
    + SNAPSHOTS
    + " SELECT release_name, "
    + ", ".join(f"{bigsum(c)} AS {c}" for c in ("executed_tests", "failed_tests", "blocked_tests", "not_run_tests"))
    + " FROM snapshots GROUP BY 1",
)(lambda i: pages.snapshot_composition(two_snapshots(i.t)))
query(
    "g18_coverage_automation_by_day",
    "WITH "
    + SNAPSHOTS
    + " SELECT snapshot_date, "
    + ", ".join(f"{bigsum(c)} AS {c}" for c in ("covered_requirements", "total_requirements", "automated_executions"))
    + " FROM snapshots GROUP BY 1",
)(lambda i: pages.coverage_automation_by_day(two_snapshots(i.t)))
query(
    "g12_governance_table",
    """SELECT release_name, total_defects, leakage_defects, total_requirements, requirements_without_tests,
              failed_runs_without_defect, defect_resolution_rate_pct, defect_reopen_rate_pct FROM v9""",
)(lambda i: pages.governance_table(i.t))
query("g13_defects_by_priority", f"SELECT priority, {P2} FROM v2 GROUP BY priority")(
    lambda i: pages.defects_by(i.t, "priority")
)
query(
    "g13_defect_detail",
    "SELECT release_name, squad_name, severity, priority, defect_status, open_defects, critical_defects FROM v2",
)(lambda i: pages.defect_detail(i.t))
COUNTS = {
    "total": "total_test_count",
    "passing": "passing_test_count",
    "failing": "failing_test_count",
    "blocked": "blocked_test_count",
}
query(
    "g14_requirement_release_counts",
    f"""SELECT issue_key, requirement_summary, release_name, {', '.join(f'{bigsum(c)} AS {n}' for n, c in COUNTS.items())}
        FROM v3 GROUP BY issue_key, requirement_summary, release_name""",
)(lambda i: pages.coverage_counts_matrix(i.t))
P4 = f"""{bigsum('total_runs')} AS p4_total_runs, {bigsum('passed')} AS p4_passed, {bigsum('failed')} AS p4_failed,
         round(avg(avg_duration_s), 6) AS p4_avg_duration_s"""
query("g15_runs_by_week_of_year", f"SELECT week_of_year, {P4} FROM v4 GROUP BY 1")(
    lambda i: pages.runs_by_week_of_year(i.t).withColumn("p4_avg_duration_s", F.round("p4_avg_duration_s", 6))
)
query("g15_trend_by_release", f"SELECT release_name, {P4} FROM v4 GROUP BY 1")(
    lambda i: pages.trend_by_release(i.t).withColumn("p4_avg_duration_s", F.round("p4_avg_duration_s", 6))
)
query(
    "g15_trend_detail",
    "SELECT run_date, squad_name, environment_name, release_name, total_runs, passed, failed, avg_duration_s FROM v4",
)(lambda i: pages.trend_detail(i.t))
query(
    "g16_runs_by_release_type",
    f"SELECT release_name, test_type_name, {bigsum('total_runs')} AS total_runs FROM v5 GROUP BY 1, 2",
)(lambda i: pages.runs_by_release_type(i.t))

# --- row-level security -----------------------------------------------------

STEP_COUNT = "SELECT coalesce(sum(length(test_run_id) % 3 + 1), 0)"
TOTALS = {
    "bridge_squad_user": "SELECT count(*) FROM bridge_squad_user",
    "dim_application": "SELECT count(*) FROM dim_application",
    "dim_date": "SELECT count(*) FROM dim_date",
    "dim_defect": "SELECT count(*) FROM dim_defect",
    "dim_environment": "SELECT count(*) FROM dim_environment",
    "dim_issue": "SELECT count(*) FROM dim_issue",
    "dim_program": "SELECT count(*) FROM dim_program",
    "dim_release": "SELECT count(*) FROM dim_release",
    "dim_root_cause": "SELECT count(*) FROM dim_root_cause",
    "dim_squad": "SELECT count(*) FROM dim_squad",
    "dim_status": "SELECT count(*) FROM dim_status",
    "dim_test": "SELECT count(*) FROM dim_test",
    "dim_test_execution": "SELECT count(*) FROM orders",
    "dim_test_type": "SELECT count(DISTINCT test_type_name) FROM dim_test",
    "dim_tester": "SELECT count(*) FROM supplier",
    "fact_defect_link": "SELECT count(*) FROM fact_defect_link",
    "fact_requirement_coverage": "SELECT count(*) FROM fact_requirement_coverage",
    "fact_test_run": "SELECT count(*) FROM fact_test_run",
    "fact_test_step_result": f"{STEP_COUNT} FROM fact_test_run",
    "pipeline_run_log": "SELECT count(*) FROM run_log",
    "pipeline_watermarks": "SELECT count(DISTINCT job_name) FROM run_log WHERE status = 'success'",
}


def visibility_sql(squads: str, own: str) -> str:
    """Rows of each table for a user with these squads (SQL) and these rows of the bridge (condition)."""
    seen = TOTALS | {
        "bridge_squad_user": f"SELECT count(*) FROM bridge_squad_user WHERE {own}",
        "dim_defect": "SELECT count(*) FROM dim_defect WHERE squad_sk IN (FROM mine)",
        "dim_issue": "SELECT count(*) FROM dim_issue WHERE squad_sk IN (FROM mine)",
        "dim_squad": "SELECT count(*) FROM dim_squad WHERE squad_sk IN (FROM mine)",
        "dim_test": "SELECT count(*) FROM dim_test WHERE squad_sk IN (FROM mine)",
        "fact_defect_link": "SELECT count(*) FROM fact_defect_link JOIN dim_defect USING (defect_sk) WHERE squad_sk IN (FROM mine)",
        "fact_requirement_coverage": "SELECT count(*) FROM fact_requirement_coverage JOIN dim_issue USING (issue_sk) WHERE squad_sk IN (FROM mine)",
        "fact_test_run": "SELECT count(*) FROM fact_test_run JOIN dim_test USING (test_sk) WHERE squad_sk IN (FROM mine)",
        "fact_test_step_result": f"{STEP_COUNT} FROM fact_test_run JOIN dim_test USING (test_sk) WHERE squad_sk IN (FROM mine)",
    }
    rows = " UNION ALL ".join(f"SELECT '{name}' AS tbl, ({seen[name]}) AS visible, ({TOTALS[name]}) AS total" for name in TOTALS)
    return f"WITH mine AS ({squads}) {rows}"


MEMBER_OF = "SELECT squad_sk FROM bridge_squad_user WHERE user_email = 'user4@example.com'"
MANAGED = "user_email = 'user2@example.com' AND role IN ('Program_Manager', 'CXO')"
PROGRAM_OF = f"""SELECT squad_sk FROM dim_squad WHERE program_sk IN (
    SELECT program_sk FROM dim_squad JOIN bridge_squad_user USING (squad_sk) WHERE {MANAGED})"""
query("r1_member_sees_own_squads", visibility_sql(MEMBER_OF, "user_email = 'user4@example.com'"))(
    lambda i: security.visibility(i.t, "user4@example.com", security.MEMBER)
)
query("r2_manager_sees_program", visibility_sql(PROGRAM_OF, MANAGED))(
    lambda i: security.visibility(i.t, "user2@example.com", security.MANAGER)
)
EVERYTHING = " UNION ALL ".join(f"SELECT '{name}' AS tbl, ({sql}) AS visible, ({sql}) AS total" for name, sql in TOTALS.items())
query("r3_executive_sees_all", EVERYTHING)(lambda i: security.visibility(i.t, "user10@example.com", security.EXECUTIVE))
NOTHING = " UNION ALL ".join(f"SELECT '{name}' AS tbl, 0 AS visible, ({sql}) AS total" for name, sql in TOTALS.items())
query("r3_no_role_sees_nothing", NOTHING)(lambda i: security.visibility(i.t, "stranger@example.com", None))
query(
    "r4_user_lookup",
    """SELECT user_email, squad_name, role FROM bridge_squad_user JOIN dim_squad USING (squad_sk)
       WHERE user_email = 'user7@example.com'""",
)(lambda i: security.user_lookup(i.t, "user7@example.com"))
query(
    "r5_access_audit",
    """SELECT user_email, role, string_agg(squad_name, ', ' ORDER BY squad_name) AS squads
       FROM bridge_squad_user JOIN dim_squad USING (squad_sk) GROUP BY user_email, role""",
)(lambda i: security.access_audit(i.t))
