"""The reporting marts on the derived star."""

from __future__ import annotations

from datetime import date

from qualitymart.operators import snapshot
from qualitymart.plans import marts
from qualitymart.queries.registry import query

SNAPSHOT_DAY = date(2001, 12, 31)


def with_snapshot(t):
    """The star with the snapshot of one day."""
    return t.replace(fact_cycle_snapshot=snapshot.cycle(t, SNAPSHOT_DAY))


query("v1_qa_health_by_release", "SELECT * FROM v1")(lambda i: marts.v1_qa_health_by_release(i.t))
query("v2_defect_density", "SELECT * FROM v2")(lambda i: marts.v2_defect_density(i.t))
query(
    "v2b_defects_by_squad",
    """SELECT squad_name, count(DISTINCT defect_sk) AS total_defects,
              count(DISTINCT defect_sk) FILTER (status IN ('Closed', 'Done', 'Resolved')) AS resolved_defects,
              count(DISTINCT defect_sk) FILTER (status NOT IN ('Closed', 'Done', 'Resolved')) AS open_defects,
              count(DISTINCT defect_sk) FILTER (severity = 'Critical') AS critical_defects,
              count(DISTINCT defect_sk) FILTER (severity = 'High') AS high_defects
       FROM dim_defect JOIN dim_squad USING (squad_sk) GROUP BY squad_name""",
)(lambda i: marts.v2b_defects_by_squad(i.t))
query("v3_requirement_coverage", "SELECT * FROM v3")(lambda i: marts.v3_requirement_coverage(i.t))
query("v4_execution_trend", "SELECT * FROM v4")(lambda i: marts.v4_execution_trend(i.t))
query("v5_test_type_breakdown", "SELECT * FROM v5")(lambda i: marts.v5_test_type_breakdown(i.t))
query("v6_test_run_detail", "SELECT * FROM v6")(lambda i: marts.v6_test_run_detail(i.t))
query("v7_environment_health", "SELECT * FROM v7")(lambda i: marts.v7_environment_health(i.t))
query("v8_release_snapshot", "SELECT * FROM v8")(lambda i: marts.v8_release_snapshot(with_snapshot(i.t)))
query(
    "v8_release_snapshot_strict",
    "SELECT * EXCLUDE (automated_executed) REPLACE ({pct:automated_executed,executed_tests} AS automation_rate_pct) FROM "
    "(SELECT v8.*, f.automated_executed FROM v8 JOIN fact_cycle_snapshot f ON f.release_name = v8.release_name "
    "AND f.squad_name IS NOT DISTINCT FROM v8.squad_name)",
)(lambda i: marts.v8_release_snapshot(with_snapshot(i.t), strict=True))
query("v9_quality_effectiveness", "SELECT * FROM v9")(lambda i: marts.v9_quality_effectiveness(i.t))
query(
    "v9_quality_effectiveness_strict",
    """SELECT v9.release_name, d.total AS total_defects, d.resolved AS resolved_defects, d.reopened AS reopened_defects,
              d.leaked AS leakage_defects, d.critical AS critical_defects,
              CAST(((200 * d.hours + d.timed) // (2 * d.timed)) / 100.0 AS DECIMAL(10, 2)) AS avg_resolution_hours,
              total_requirements, covered_requirements, requirements_without_tests, total_runs, failed_runs,
              failed_runs_without_defect, {pct:d.resolved,d.total} AS defect_resolution_rate_pct,
              {pct:d.reopened,d.resolved} AS defect_reopen_rate_pct, {pct:d.leaked,d.total} AS defect_leakage_rate_pct,
              {pct:d.total - d.leaked,d.total} AS defect_removal_efficiency_pct, requirement_coverage_pct,
              requirements_without_tests_pct, failed_runs_without_defect_pct
       FROM v9 JOIN (
           SELECT release_name, count(*) AS total, count(*) FILTER (status = 'Closed') AS resolved,
                  count(*) FILTER (status = 'Reopened') AS reopened, count(*) FILTER (leakage_flag) AS leaked,
                  count(*) FILTER (critical_flag) AS critical, CAST(sum(resolution_days * 24) AS BIGINT) AS hours,
                  count(resolution_days) AS timed
           FROM (SELECT DISTINCT release_name, defect_sk FROM fact_defect_link) JOIN dim_defect USING (defect_sk)
           GROUP BY release_name) d ON d.release_name = v9.release_name""",
)(lambda i: marts.v9_quality_effectiveness(i.t, strict=True))


def registered(i):
    """The marts as SQL views over the registered tables."""
    marts.register_views(with_snapshot(i.t))
    return i.spark.sql("SELECT v.*, r.release_status AS status_of_table FROM vw_p1_qa_health_by_release v JOIN dim_release r USING (release_name)")


query("s13_registered_views", "SELECT *, release_status AS status_of_table FROM v1")(registered)
