"""DuckDB definitions of the derived star, put in front of each query's SQL.

They restate the derivation rules independently of the Spark code.
"""

from __future__ import annotations

import re

# table name -> SQL body; a body may use tables defined before it.
STAR = {
    "dim_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_sk, CAST(d AS DATE) AS full_date, year(d) AS year,
               quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name, weekofyear(d) AS week_of_year,
               day(d) AS day_of_month, isodow(d) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend
        FROM (SELECT unnest(generate_series(date_trunc('year', min(o_orderdate))::TIMESTAMP,
                     date_trunc('year', max(o_orderdate))::TIMESTAMP + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d
              FROM orders)""",
    "dim_program": "SELECT r_regionkey AS program_sk, r_name AS program_name FROM region",
    "dim_application": "SELECT DISTINCT p_brand AS application_sk, p_brand AS application_name FROM part",
    "dim_squad": """
        SELECT n_nationkey AS squad_sk, n_name AS squad_name, n_regionkey AS program_sk,
               'Brand#' || (n_nationkey + 1) AS application_sk
        FROM nation""",
    "dim_environment": """
        SELECT * FROM (VALUES ('DEV', 'DEV', 'Development', 'Low'), ('SIT', 'SIT', 'Integration', 'Medium'),
                              ('UAT', 'UAT', 'Acceptance', 'High'))
            v(environment_sk, environment_name, environment_type, criticality)""",
    "dim_root_cause": """
        SELECT * FROM (VALUES (1, 'Environment Outage', 'Infra'), (2, 'Environment Config', 'Infra'),
                              (3, 'Test Data Missing', 'Data'), (4, 'Test Data Corrupt', 'Data'),
                              (5, 'Application Bug', 'App'), (6, 'Application Config', 'Config'),
                              (7, 'Network Timeout', 'Network'), (8, 'Build Failure', 'Process'),
                              (9, 'Not Applicable', 'N/A')) v(n, root_cause_name, root_cause_category)""",
    "dim_status": """
        SELECT * FROM (VALUES ('PASS', 'Pass', 1), ('FAIL', 'Fail', 2), ('BLOCKED', 'Blocked', 3),
                              ('EXECUTING', 'Active', 4), ('TODO', 'Pending', 5), ('ABORTED', 'Skipped', 6))
            v(status_name, status_category, sort_order)""",
    "dim_tester": """
        SELECT s_suppkey AS tester_sk, s_name AS tester_name, 'Team ' || s_nationkey AS team_name FROM supplier""",
    "dim_test": """
        SELECT p_partkey AS test_sk, 'T-' || p_partkey AS test_key, p_name AS summary,
               CASE WHEN p_partkey % 37 = 5 THEN NULL WHEN p_type IN ('STANDARD', 'ECONOMY') THEN 'Manual' WHEN p_type = 'PROMO' THEN 'Cucumber'
                    WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'Generic' WHEN p_type = 'LARGE' THEN 'Regression'
               END AS test_type_name,
               CASE WHEN p_partkey % 10 <> 3 THEN '/repo/' || p_brand END AS repository_path,
               CASE WHEN p_partkey % 50 <> 0 THEN CAST((p_partkey % 6) * 4 AS INT) END AS squad_sk
        FROM part""",
    "runs": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS test_run_id,
               date_trunc('week', l_shipdate)::TIMESTAMP AS started_at,
               CASE l_returnflag || l_linestatus WHEN 'AF' THEN CASE WHEN l_shipdate BETWEEN TIMESTAMP '1996-04-01'
                    AND TIMESTAMP '1996-07-06' THEN 'EXECUTING' ELSE 'PASS' END WHEN 'AO' THEN 'ABORTED'
                    WHEN 'NF' THEN 'EXECUTING' WHEN 'NO' THEN 'TODO' WHEN 'RF' THEN 'FAIL' WHEN 'RO' THEN 'BLOCKED'
               END AS run_status, l_quantity, l_returnflag || l_linestatus AS comment
        FROM lineitem""",
    "fact_test_run": """
        SELECT r.l_orderkey, r.l_suppkey, r.l_extendedprice, r.test_run_id,
               'R' || year(r.started_at) || 'Q' || quarter(r.started_at) AS release_name,
               r.l_partkey AS test_sk, r.l_orderkey AS execution_sk, r.l_suppkey AS tester_sk,
               CASE WHEN l_linenumber <= 2 THEN 'DEV' WHEN l_linenumber <= 4 THEN 'SIT' WHEN l_linenumber <= 6 THEN 'UAT'
               END AS environment_name,
               CASE WHEN r.run_status IN ('FAIL', 'BLOCKED') THEN rc.root_cause_name ELSE 'Not Applicable' END AS root_cause_name,
               CAST(strftime(r.started_at, '%Y%m%d') AS INT) AS date_sk, r.run_status,
               t.test_type_name <> 'Manual' AS is_automated, r.run_status = 'BLOCKED' AS is_blocked,
               CASE WHEN r.run_status = 'BLOCKED' AND r.l_partkey % 4 <> 0 THEN rc.root_cause_name END AS block_reason,
               r.started_at, CASE WHEN r.run_status <> 'TODO' THEN r.l_quantity * 60 END AS duration_s,
               CASE WHEN r.run_status <> 'TODO' THEN r.started_at + to_seconds(r.l_quantity * 60) END AS finished_at,
               'user-' || r.l_suppkey AS executed_by, r.comment,
               CASE WHEN r.run_status IN ('FAIL', 'BLOCKED') AND r.l_suppkey % 4 <> 0 THEN 1 ELSE 0 END AS defect_count
        FROM runs r JOIN dim_test t ON t.test_sk = r.l_partkey
        JOIN dim_root_cause rc ON rc.n = r.l_partkey % 9 + 1""",
    "dim_release": """
        SELECT release_name, make_date(y, q * 3 - 2, 1) AS release_date,
               CASE WHEN y < 2000 THEN 'Released' WHEN y = 2000 THEN 'In Progress' ELSE 'Planning' END AS release_status
        FROM (SELECT DISTINCT 'R' || year || 'Q' || quarter AS release_name, year AS y, quarter AS q FROM dim_date)""",
    "dim_defect": """
        SELECT o_orderkey AS defect_sk, 'D-' || o_orderkey AS defect_key, 'Defect of order ' || o_orderkey AS summary,
               CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'Closed' WHEN o_orderstatus = 'O' THEN 'Open'
                    WHEN o_orderstatus = 'P' THEN 'Reopened' END AS status,
               o_orderpriority AS priority,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Critical' WHEN '2-HIGH' THEN 'High'
                    WHEN '3-MEDIUM' THEN 'Medium' ELSE 'Low' END AS severity,
               CAST((o_orderkey % 6) * 4 AS INT) AS squad_sk, o_orderdate AS created_at,
               CASE WHEN o_orderkey % 7 <> 0 THEN 'user-' || (o_orderkey % 100) END AS assignee,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(CAST(o_orderkey % 30 AS INT)) END AS resolved_at,
               CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 30 END AS resolution_days,
               o_orderpriority = '1-URGENT' AS critical_flag, o_orderkey % 17 = 0 AS leakage_flag,
               CASE WHEN o_orderkey % 5 <> 0 THEN 'Application Bug' END AS root_cause
        FROM orders""",
    "dim_issue": """
        SELECT c_custkey AS issue_sk, 'REQ-' || c_custkey AS issue_key, 'Story' AS issue_type, c_name AS summary,
               CASE WHEN c_custkey % 3 = 0 THEN 'Done' ELSE 'In Progress' END AS status,
               CASE WHEN c_acctbal > 8000 THEN 'Highest' WHEN c_custkey % 20 = 0 THEN NULL ELSE 'Medium' END AS priority,
               CASE WHEN c_custkey % 40 <> 0 THEN CAST((c_custkey % 6) * 4 AS INT) END AS squad_sk,
               CASE WHEN c_custkey % 60 <> 0 THEN c_nationkey % 5 END AS program_sk,
               c_acctbal > 8000 AS critical_flag, c_mktsegment AS business_area
        FROM customer""",
    "fact_defect_link": """
        SELECT DISTINCT d.defect_key, d.defect_sk, r.test_run_id, r.release_name, d.status <> 'Closed' AS open_flag
        FROM fact_test_run r JOIN dim_defect d ON d.defect_sk = r.l_orderkey WHERE r.defect_count = 1""",
    "latest_requirement_run": """
        SELECT o_custkey AS issue_sk, release_name, test_sk, CASE WHEN o_custkey % 30 = 0 THEN 'TODO' ELSE run_status END AS run_status, date_sk
        FROM fact_test_run JOIN orders ON o_orderkey = l_orderkey WHERE o_custkey % 45 <> 7
        QUALIFY row_number() OVER (PARTITION BY o_custkey, release_name, test_sk
                                   ORDER BY started_at DESC, test_run_id DESC, l_extendedprice DESC) = 1""",
    "fact_requirement_coverage": """
        SELECT *, CASE WHEN failing_test_count > 0 THEN 'FAIL' WHEN blocked_test_count > 0 THEN 'BLOCKED'
                       WHEN executing_test_count > 0 THEN 'EXECUTING' WHEN todo_test_count > 0 THEN 'TODO' ELSE 'PASS'
                  END AS coverage_status,
               passing_test_count > 0 AND passing_test_count < total_test_count AS partial_coverage_flag,
               failing_test_count > 0 AS failed_coverage_flag, passing_test_count > 0 AS is_covered, 0 AS no_coverage_count
        FROM (SELECT issue_sk, release_name, count(*) AS total_test_count,
                     count(*) FILTER (run_status = 'PASS') AS passing_test_count,
                     count(*) FILTER (run_status = 'FAIL') AS failing_test_count,
                     count(*) FILTER (run_status = 'BLOCKED') AS blocked_test_count,
                     count(*) FILTER (run_status = 'EXECUTING') AS executing_test_count,
                     count(*) FILTER (run_status IN ('TODO', 'ABORTED')) AS todo_test_count,
                     max(date_sk) AS latest_execution_date_sk
              FROM latest_requirement_run GROUP BY ALL)""",
    "run_squad": """
        SELECT r.*, t.test_key, t.summary AS test_summary, t.test_type_name, s.squad_name, s.program_sk
        FROM fact_test_run r JOIN dim_test t USING (test_sk) LEFT JOIN dim_squad s USING (squad_sk)""",
    "v1": """
        SELECT f.release_name, any_value(release_date) AS release_date, any_value(release_status) AS release_status,
               count(*) AS total_runs, count(*) FILTER (run_status = 'PASS') AS passed,
               count(*) FILTER (run_status = 'FAIL') AS failed, count(*) FILTER (run_status = 'BLOCKED') AS blocked,
               count(*) FILTER (run_status = 'EXECUTING') AS executing, count(*) FILTER (run_status = 'TODO') AS todo,
               count(*) FILTER (run_status = 'ABORTED') AS aborted, count(*) FILTER (is_automated) AS automated_runs,
               {pct:passed,total_runs} AS pass_rate_pct
        FROM fact_test_run f JOIN dim_release r ON r.release_name = f.release_name GROUP BY f.release_name""",
    "v2": """
        SELECT l.release_name, s.squad_name, d.severity, d.priority, d.status AS defect_status,
               count(DISTINCT l.defect_key) AS total_defects, count(*) FILTER (l.open_flag) AS open_defects,
               count(*) FILTER (d.critical_flag) AS critical_defects, count(DISTINCT l.test_run_id) AS impacted_runs
        FROM fact_defect_link l LEFT JOIN dim_defect d USING (defect_sk) LEFT JOIN dim_squad s USING (squad_sk)
        GROUP BY ALL""",
    "v3": """
        SELECT i.issue_key, i.summary AS requirement_summary, i.issue_type, i.priority,
               i.critical_flag AS is_critical_requirement, i.business_area, s.squad_name, c.release_name,
               c.total_test_count, c.passing_test_count, c.failing_test_count, c.blocked_test_count, c.todo_test_count,
               c.no_coverage_count, c.coverage_status, c.is_covered, c.partial_coverage_flag, c.failed_coverage_flag
        FROM fact_requirement_coverage c JOIN dim_issue i USING (issue_sk) LEFT JOIN dim_squad s USING (squad_sk)""",
    "v4": """
        SELECT CAST(r.started_at AS DATE) AS run_date, d.date_sk, d.year, d.month, d.week_of_year, r.squad_name,
               r.environment_name, r.release_name, count(*) AS total_runs,
               count(*) FILTER (run_status = 'PASS') AS passed, count(*) FILTER (run_status = 'FAIL') AS failed,
               count(*) FILTER (run_status = 'BLOCKED') AS blocked, count(*) FILTER (is_automated) AS automated_runs,
               avg(duration_s) AS avg_duration_s
        FROM run_squad r LEFT JOIN dim_date d ON d.date_sk = r.date_sk GROUP BY ALL""",
    "v5": """
        SELECT test_type_name, squad_name, release_name, count(*) AS total_runs,
               count(*) FILTER (run_status = 'PASS') AS passed, count(*) FILTER (run_status = 'FAIL') AS failed,
               count(*) FILTER (run_status = 'BLOCKED') AS blocked, {pct:passed,total_runs} AS pass_rate_pct
        FROM run_squad GROUP BY test_type_name, squad_name, release_name""",
    "v6": """
        SELECT r.test_run_id, r.test_key, r.test_summary, r.test_type_name, 'E-' || o.o_orderkey AS execution_key,
               o.o_orderpriority AS execution_summary, 'rev-' || (o.o_orderkey % 10) AS revision, r.environment_name,
               e.environment_type, r.release_name, rel.release_status, r.squad_name, r.run_status, s.status_category,
               1 AS run_sequence, r.is_automated, r.is_blocked, r.block_reason, r.started_at, r.finished_at, r.duration_s,
               te.tester_name, te.team_name, r.executed_by, r.comment, r.defect_count, r.root_cause_name,
               rc.root_cause_category
        FROM run_squad r JOIN dim_release rel ON rel.release_name = r.release_name
        LEFT JOIN orders o ON o.o_orderkey = r.execution_sk
        LEFT JOIN dim_environment e ON e.environment_name = r.environment_name
        LEFT JOIN dim_tester te ON te.tester_sk = r.tester_sk
        LEFT JOIN dim_status s ON s.status_name = r.run_status
        LEFT JOIN dim_root_cause rc ON rc.root_cause_name = r.root_cause_name""",
    "v7": """
        SELECT r.environment_name, e.environment_type, e.criticality, r.release_name, r.squad_name, r.root_cause_name,
               rc.root_cause_category, CAST(r.started_at AS DATE) AS execution_date, count(*) AS total_runs,
               count(*) FILTER (run_status = 'FAIL') AS failed_runs,
               count(*) FILTER (run_status = 'BLOCKED') AS blocked_runs,
               {pct:count(*) FILTER (run_status = 'PASS'),count(*)} AS pass_rate_pct
        FROM run_squad r LEFT JOIN dim_environment e ON e.environment_name = r.environment_name
        LEFT JOIN dim_root_cause rc ON rc.root_cause_name = r.root_cause_name
        GROUP BY r.environment_name, e.environment_type, e.criticality, r.release_name, r.squad_name, r.root_cause_name,
                 rc.root_cause_category, CAST(r.started_at AS DATE)""",
    "fact_cycle_snapshot": """
        SELECT r.release_name, r.squad_name, r.total_tests, r.executed_tests, r.passed_tests, r.failed_tests, r.blocked_tests,
               r.not_run_tests, r.automated_executions, r.automated_executed, coalesce(c.covered, 0) AS covered_requirements,
               coalesce(c.total, 0) AS total_requirements, coalesce(d.n, 0) AS open_critical_defects, r.avg_duration_s
        FROM (SELECT release_name, squad_name, count(*) AS total_tests,
                     count(*) FILTER (run_status NOT IN ('TODO', 'EXECUTING')) AS executed_tests,
                     count(*) FILTER (run_status = 'PASS') AS passed_tests,
                     count(*) FILTER (run_status = 'FAIL') AS failed_tests,
                     count(*) FILTER (run_status = 'BLOCKED') AS blocked_tests,
                     count(*) FILTER (run_status = 'TODO') AS not_run_tests,
                     count(*) FILTER (is_automated) AS automated_executions,
                     count(*) FILTER (is_automated AND run_status NOT IN ('TODO', 'EXECUTING')) AS automated_executed,
                     avg(duration_s) AS avg_duration_s
              FROM run_squad GROUP BY ALL) r
        LEFT JOIN (SELECT release_name, squad_name, count(*) FILTER (is_covered) AS covered, count(*) AS total
                   FROM v3 GROUP BY ALL) c
            ON c.release_name = r.release_name AND c.squad_name IS NOT DISTINCT FROM r.squad_name
        LEFT JOIN (SELECT release_name, squad_name, count(DISTINCT l.defect_key) AS n
                   FROM fact_defect_link l JOIN dim_defect d USING (defect_sk) LEFT JOIN dim_squad s USING (squad_sk)
                   WHERE l.open_flag AND d.critical_flag GROUP BY ALL) d
            ON d.release_name = r.release_name AND d.squad_name IS NOT DISTINCT FROM r.squad_name""",
    "v8": """
        SELECT DATE '2001-12-31' AS snapshot_date, 2001 AS year, 12 AS month, f.release_name, rel.release_date,
               rel.release_status, f.squad_name, total_tests, executed_tests, passed_tests, failed_tests, blocked_tests,
               not_run_tests, automated_executions, covered_requirements, total_requirements, open_critical_defects,
               avg_duration_s, {pct:passed_tests,executed_tests} AS pass_rate_pct,
               {pct:covered_requirements,total_requirements} AS coverage_rate_pct,
               {pct:automated_executions,executed_tests} AS automation_rate_pct
        FROM fact_cycle_snapshot f JOIN dim_release rel ON rel.release_name = f.release_name""",
    "v9": """
        SELECT rel.release_name, coalesce(d.total, 0) AS total_defects, coalesce(d.resolved, 0) AS resolved_defects,
               coalesce(d.reopened, 0) AS reopened_defects, coalesce(d.leaked, 0) AS leakage_defects,
               coalesce(d.critical, 0) AS critical_defects,
               CAST(coalesce(((200 * d.hours + d.timed) // (2 * d.timed)) / 100.0, 0) AS DECIMAL(10, 2)) AS avg_resolution_hours,
               coalesce(c.total, 1) AS total_requirements, coalesce(c.covered, 0) AS covered_requirements,
               0 AS requirements_without_tests, coalesce(r.total, 1) AS total_runs, coalesce(r.failed, 0) AS failed_runs,
               coalesce(r.orphan, 0) AS failed_runs_without_defect,
               {pct:resolved_defects,total_defects} AS defect_resolution_rate_pct,
               {pct:reopened_defects,resolved_defects} AS defect_reopen_rate_pct,
               {pct:leakage_defects,total_defects} AS defect_leakage_rate_pct,
               {pct:(total_defects - leakage_defects),total_defects} AS defect_removal_efficiency_pct,
               {pct:covered_requirements,total_requirements} AS requirement_coverage_pct,
               {pct:requirements_without_tests,total_requirements} AS requirements_without_tests_pct,
               {pct:failed_runs_without_defect,failed_runs} AS failed_runs_without_defect_pct
        FROM dim_release rel
        LEFT JOIN (SELECT l.release_name, count(DISTINCT d.defect_key) AS total,
                          count(*) FILTER (d.status IN ('Closed', 'Done', 'Resolved', 'Won''t Fix')) AS resolved,
                          count(*) FILTER (d.status = 'Reopened') AS reopened, count(*) FILTER (d.leakage_flag) AS leaked,
                          count(*) FILTER (d.critical_flag) AS critical, CAST(sum(d.resolution_days * 24) AS BIGINT) AS hours,
                          count(d.resolution_days) AS timed
                   FROM fact_defect_link l JOIN dim_defect d USING (defect_sk) GROUP BY ALL) d USING (release_name)
        LEFT JOIN (SELECT release_name, count(*) AS total, count(*) FILTER (is_covered) AS covered
                   FROM fact_requirement_coverage GROUP BY ALL) c USING (release_name)
        LEFT JOIN (SELECT release_name, count(*) AS total, count(*) FILTER (run_status = 'FAIL') AS failed,
                          count(*) FILTER (run_status = 'FAIL' AND defect_count = 0) AS orphan
                   FROM fact_test_run GROUP BY ALL) r USING (release_name)""",
    "bridge_squad_user": """
        SELECT DISTINCT unnest([s_nationkey, CAST((s_suppkey % 6) * 4 AS INT)]) AS squad_sk,
               'user' || s_suppkey || '@example.com' AS user_email,
               CASE WHEN s_suppkey % 10 = 0 THEN 'CXO' WHEN s_suppkey % 10 <= 2 THEN 'Program_Manager'
                    ELSE 'Squad_Member' END AS role
        FROM supplier""",
    "run_log": """
        SELECT CAST(event_id AS VARCHAR) AS pipeline_run_id, 'job_' || (user_id % 10) AS job_name,
               CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status, ts AS started_at,
               ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS finished_at,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS records_extracted,
               CASE WHEN event_type = 'error' THEN 0 ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS rows_upserted,
               CASE WHEN event_type = 'error' THEN 'failed on ' || props END AS error_message
        FROM events""",
}


def pct(part: str, whole: str) -> str:
    """Exact half-up percentage on integers, NULL over zero."""
    p, w = f"CAST(({part}) AS BIGINT)", f"nullif(CAST(({whole}) AS BIGINT), 0)"
    return f"CAST(((20000 * {p} + {w}) // (2 * {w})) / 100.0 AS DECIMAL(5, 2))"


def ratio(part: str, whole: str) -> str:
    """Percentage in doubles, zero when the whole is zero or missing."""
    return f"coalesce(CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0), 0.0) * 100"


def expand(sql: str) -> str:
    """Replace ``{pct:a,b}`` and ``{ratio:a,b}`` by their SQL."""
    sql = re.sub(r"\{pct:(.+?),([^,{}]+)\}", lambda m: pct(m[1], m[2]), sql)
    return re.sub(r"\{ratio:(.+?),([^,{}]+)\}", lambda m: ratio(m[1], m[2]), sql)


def with_star(sql: str) -> str:
    """The query with the star tables it needs, directly or through others, in front."""
    needed: set[str] = set()

    def visit(body: str) -> None:
        for name in STAR:
            if name not in needed and re.search(rf"\b{name}\b", body):
                needed.add(name)
                visit(STAR[name])

    visit(sql)
    ctes = [f"{name} AS ({expand(STAR[name])})" for name in STAR if name in needed]
    body = expand(sql).strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
