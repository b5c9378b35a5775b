"""Data-quality checks on the derived star."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from qualitymart.operators import quality as Q
from qualitymart.queries.registry import RAW_SQL, build, query

DAY = date(2001, 6, 30)
NOON = datetime(2024, 1, 25, 12)

query(
    "d1_tests_without_recent_run",
    """SELECT test_key, summary FROM dim_test WHERE test_sk NOT IN
       (SELECT test_sk FROM fact_test_run WHERE started_at >= TIMESTAMP '2001-06-30' - INTERVAL 30 DAY)""",
)(lambda i: Q.tests_without_recent_run(i.t, DAY))
query(
    "d2_releases_without_pass",
    """SELECT release_name, count(*) AS total_runs FROM run_squad
       GROUP BY release_name HAVING count(*) FILTER (run_status = 'PASS') = 0""",
)(lambda i: Q.releases_without_pass(i.t).select("release_name", "total_runs"))
query(
    "d3_failed_jobs",
    """SELECT pipeline_run_id, job_name, started_at, error_message FROM run_log
       WHERE status = 'failed' AND started_at >= TIMESTAMP '2024-01-18 12:00:00'""",
)(
    lambda i: Q.failed_jobs(i.t["pipeline_run_log"], NOON).select("pipeline_run_id", "job_name", "started_at", "error_message")
)
query(
    "d3_last_jobs",
    """SELECT pipeline_run_id, job_name, status, strftime(started_at, '%Y-%m-%d %H:%M') AS started,
              strftime(finished_at, '%Y-%m-%d %H:%M') AS finished, datediff('second', started_at, finished_at) AS duration_s,
              records_extracted, rows_upserted, left(coalesce(error_message, ''), 400) AS error
       FROM run_log ORDER BY started_at DESC, pipeline_run_id LIMIT 20""",
)(lambda i: Q.last_jobs(i.t["pipeline_run_log"], 20))
query(
    "d4_doubtful_watermarks",
    """SELECT job_name, last_success_ts, CASE WHEN last_success_ts < TIMESTAMP '2024-01-30 22:00:00' - INTERVAL 1 HOUR THEN 'stale' ELSE 'future' END AS finding
       FROM (SELECT job_name, max(started_at) AS last_success_ts FROM run_log WHERE status = 'success' GROUP BY 1)
       WHERE last_success_ts < TIMESTAMP '2024-01-30 22:00:00' - INTERVAL 1 HOUR OR last_success_ts > TIMESTAMP '2024-01-30 22:00:00'""",
)(lambda i: Q.doubtful_watermarks(i.t["pipeline_watermarks"], datetime(2024, 1, 30, 22), hours=1))
query(
    "d5_census",
    """SELECT 'dim_date' AS tbl, count(*) AS n FROM dim_date UNION ALL SELECT 'dim_release', count(*) FROM dim_release
       UNION ALL SELECT 'dim_test', count(*) FROM dim_test UNION ALL SELECT 'fact_test_run', count(*) FROM fact_test_run
       UNION ALL SELECT 'fact_requirement_coverage', count(*) FROM fact_requirement_coverage
       UNION ALL SELECT 'dim_defect', count(*) FROM dim_defect""",
)(lambda i: Q.census(i.t))
query(
    "d5_date_like_applications",
    "SELECT DISTINCT '2024-01-' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0') AS application_name FROM part WHERE p_size % 2 = 0",
)(
    lambda i: Q.date_like_applications(
        i.t.replace(
            dim_application=i.raw("part")
            .selectExpr(
                "CASE WHEN p_size % 2 = 0 THEN concat('2024-01-', lpad(cast(p_size % 28 + 1 as string), 2, '0')) ELSE p_brand END AS application_name"
            )
            .distinct()
        )
    )
)
query(
    "d6_unknown_run_status",
    """SELECT test_run_id, CASE WHEN run_status = 'ABORTED' THEN 'Passed' END AS run_status FROM fact_test_run
       WHERE run_status = 'ABORTED' OR run_status = 'TODO'""",
)(
    lambda i: Q.unknown_run_status(
        i.t.replace(
            fact_test_run=i.t["fact_test_run"].withColumn(
                "run_status", F.expr("CASE run_status WHEN 'ABORTED' THEN 'Passed' WHEN 'TODO' THEN NULL ELSE run_status END")
            )
        )
    )
)
query("d6_unknown_severity", "SELECT defect_key, 'Sev3' AS severity FROM dim_defect WHERE severity = 'Medium'")(
    lambda i: Q.unknown_severity(
        i.t.replace(
            dim_defect=i.t["dim_defect"].withColumn(
                "severity", F.expr("CASE severity WHEN 'Medium' THEN 'Sev3' WHEN 'Low' THEN NULL ELSE severity END")
            )
        )
    )
)
query(
    "d7_incomplete_requirements",
    """SELECT issue_key, concat_ws(',', CASE WHEN squad_sk IS NULL THEN 'squad' END, CASE WHEN program_sk IS NULL THEN 'program' END,
              CASE WHEN squad_sk IS NULL THEN 'application' END, CASE WHEN priority IS NULL THEN 'priority' END,
              CASE WHEN issue_sk NOT IN (SELECT issue_sk FROM fact_requirement_coverage) THEN 'release' END) AS missing
       FROM dim_issue WHERE status <> 'Done' AND missing <> ''""",
)(lambda i: Q.incomplete_requirements(i.t))
query(
    "d8_failures_without_defect",
    "SELECT test_run_id, release_name FROM fact_test_run WHERE run_status = 'FAIL' AND defect_count = 0",
)(
    lambda i: Q.failures_without_defect(i.t)
    .join(i.t["dim_release"].select("release_sk", "release_name"), "release_sk")
    .drop("release_sk")
)
query(
    "d9_requirements_without_tests",
    """SELECT issue_key, business_area, critical_flag FROM dim_issue
       WHERE issue_sk NOT IN (SELECT issue_sk FROM fact_requirement_coverage)""",
)(lambda i: Q.requirements_without_tests(i.t))
query(
    "d10_incomplete_closed_defects",
    """SELECT defect_key, 'root_cause' AS missing FROM dim_defect WHERE status = 'Closed' AND root_cause IS NULL""",
)(lambda i: Q.incomplete_closed_defects(i.t))
query(
    "d11_incomplete_runs",
    """SELECT test_run_id, run_status, 'block_reason' AS missing FROM fact_test_run WHERE run_status = 'BLOCKED' AND block_reason IS NULL
       UNION ALL SELECT test_run_id, run_status, 'environment' FROM fact_test_run WHERE environment_name IS NULL
       UNION ALL SELECT test_run_id, run_status, 'timestamp' FROM fact_test_run
                 WHERE run_status IN ('PASS', 'FAIL') AND (started_at IS NULL OR finished_at IS NULL)""",
)(lambda i: Q.incomplete_runs(i.t))
query(
    "d12_stale_executing",
    """SELECT test_run_id, started_at FROM fact_test_run
       WHERE run_status = 'EXECUTING' AND started_at < TIMESTAMP '2001-06-30' - INTERVAL 7 DAY""",
)(lambda i: Q.stale_executing(i.t, DAY, 7))
query(
    "d13_done_but_untested",
    """SELECT issue_key, CAST(sum(total_test_count) AS BIGINT) AS tests FROM dim_issue JOIN fact_requirement_coverage USING (issue_sk)
       WHERE status = 'Done' GROUP BY issue_key HAVING sum(total_test_count) = sum(todo_test_count)""",
)(lambda i: Q.done_but_untested(i.t))
query(
    "d14_resolved_but_failing",
    """WITH latest AS (SELECT test_sk, test_run_id, run_status FROM fact_test_run
                       QUALIFY row_number() OVER (PARTITION BY test_sk ORDER BY started_at DESC, test_run_id DESC, run_status DESC) = 1)
       SELECT DISTINCT d.defect_key, l.test_sk, l.test_run_id AS failing_run
       FROM latest l JOIN fact_test_run r ON r.test_sk = l.test_sk JOIN fact_defect_link k ON k.test_run_id = r.test_run_id
       JOIN dim_defect d ON d.defect_sk = k.defect_sk WHERE l.run_status = 'FAIL' AND d.status = 'Closed'""",
)(lambda i: Q.resolved_but_failing(i.t))
query(
    "d15_squad_mismatches",
    """SELECT i.issue_key, t.test_key, i.squad_sk AS issue_squad, t.squad_sk AS test_squad
       FROM (SELECT DISTINCT o_custkey AS issue_sk, l_partkey AS test_sk FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_custkey % 45 <> 7) l
       JOIN dim_issue i USING (issue_sk) JOIN dim_test t USING (test_sk) WHERE i.squad_sk IS DISTINCT FROM t.squad_sk""",
)(lambda i: Q.squad_mismatches(i.t, i.derived.requirement_runs().select("issue_sk", "test_sk")))
query(
    "d15_tests_without_definition",
    """SELECT test_key, summary FROM dim_test WHERE test_type_name IN ('Manual', 'Regression')
              OR test_type_name IS NULL OR (test_type_name = 'Generic' AND test_sk % 7 = 0)""",
)(lambda i: Q.tests_without_definition(i.t))
query(
    "d15_type_changes",
    """WITH history AS (SELECT 'T-' || l_partkey AS test_key, CASE WHEN l_suppkey % 2 = 0 THEN 'Manual' ELSE 'Generic' END AS tt,
                               l_shipdate AS loaded_at, l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem),
            firsts AS (SELECT 'T-' || l_partkey AS test_key, min(l_shipdate) AS first_run FROM lineitem GROUP BY 1),
            ends AS (SELECT test_key, min_by(tt, (loaded_at, l_orderkey, l_linenumber, l_suppkey, l_extendedprice)) AS first_type,
                            max_by(tt, (loaded_at, l_orderkey, l_linenumber, l_suppkey, l_extendedprice)) AS last_type, count(DISTINCT loaded_at) AS days
                     FROM history GROUP BY 1)
       SELECT test_key, first_type, last_type FROM ends JOIN firsts USING (test_key) WHERE days > 1 AND first_type <> last_type""",
)(
    lambda i: Q.type_changes(
        i.raw("lineitem").selectExpr(
            "concat('T-', l_partkey) AS test_key",
            "CASE WHEN l_suppkey % 2 = 0 THEN 'Manual' ELSE 'Generic' END AS test_type_name",
            "l_shipdate AS loaded_at",
            "struct(l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS ord",
        ),
        i.raw("lineitem").selectExpr("concat('T-', l_partkey) AS test_key", "l_shipdate AS started_at"),
    )
)
query(
    "d17_missing_seeds",
    """SELECT 'dim_status' AS tbl, status_name AS missing FROM dim_status
       WHERE status_name NOT IN (SELECT DISTINCT run_status FROM fact_test_run WHERE run_status <> 'ABORTED')
       UNION ALL SELECT 'dim_root_cause', root_cause_name FROM dim_root_cause
       WHERE root_cause_name NOT IN (SELECT DISTINCT root_cause_name FROM fact_test_run WHERE run_status = 'TODO')""",
)(
    lambda i: Q.missing_seeds(
        i.t.replace(
            dim_status=i.t["fact_test_run"].where("run_status <> 'ABORTED'").selectExpr("run_status AS status_name").distinct(),
            dim_root_cause=i.t["fact_test_run"]
            .where("run_status = 'TODO'")
            .select("root_cause_sk")
            .distinct()
            .join(i.t["dim_root_cause"], "root_cause_sk"),
        )
    )
)
query(
    "d17_short_calendar",
    """SELECT 'dim_date' AS tbl, 'calendar rows' AS missing FROM (SELECT count(*) AS n FROM dim_date
       WHERE month <= 6 AND year = (SELECT min(year) FROM dim_date)) WHERE n < 365""",
)(
    lambda i: Q.missing_seeds(
        i.t.replace(dim_date=i.t["dim_date"].where("month <= 6").join(i.t["dim_date"].agg(F.min("year").alias("year")), "year", "left_semi"))
    ).where("tbl = 'dim_date'")
)
SUMMARISED = [name for name in RAW_SQL if name.startswith("d") and name not in ("d3_last_jobs", "d5_census")]
query(
    "d_summary",
    " UNION ALL ".join(f"SELECT '{name}' AS \"check\", count(*) AS violations FROM ({RAW_SQL[name]})" for name in SUMMARISED),
)(lambda i: Q.summary({name: build(name, i) for name in SUMMARISED}))
