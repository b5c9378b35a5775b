"""Measures on the derived star."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from qualitymart.functions import measures as M
from qualitymart.operators import distinct, windows
from qualitymart.plans import marts, pages
from qualitymart.plans.context import Context, apply_context, with_date, with_dims
from qualitymart.queries.marts import with_snapshot
from qualitymart.queries.registry import query
from qualitymart.session import cut

RUN_MEASURES = """
    count(*) AS total_runs, count(*) FILTER (run_status = 'PASS') AS passed_runs,
    count(*) FILTER (run_status = 'FAIL') AS failed_runs, count(*) FILTER (run_status = 'BLOCKED') AS blocked_runs,
    count(*) FILTER (run_status = 'TODO') AS todo_runs, count(*) FILTER (run_status = 'EXECUTING') AS executing_runs,
    count(*) FILTER (run_status = 'ABORTED') AS aborted_runs, {ratio:passed_runs,total_runs} AS pass_rate,
    CAST(((2000 * passed_runs + total_runs) // (2 * total_runs)) / 10.0 AS DECIMAL(18, 1)) || '%' AS pass_rate_formatted,
    CASE WHEN pass_rate >= 80 THEN 'On Track' ELSE 'At Risk' END AS pass_rate_status,
    avg(duration_s) AS avg_duration_s, avg(duration_s) / 60.0 AS avg_duration_min,
    coalesce(sum(duration_s) / 3600.0, 0) AS total_test_hours, max(duration_s) AS max_duration_s,
    count(*) FILTER (is_automated) AS automated_runs, {ratio:automated_runs,total_runs} AS automation_rate"""

query("m1_run_measures_by_release", f"SELECT release_name, {RUN_MEASURES} FROM fact_test_run GROUP BY release_name")(
    lambda i: M.evaluate(with_dims(i.t, "fact_test_run", pages.RELEASE), ["release_name"], M.run_measures())
)
query(
    "m1_run_measures_by_program_squad",
    f"""SELECT program_name, squad_name, {RUN_MEASURES}
        FROM run_squad LEFT JOIN dim_program USING (program_sk) GROUP BY program_name, squad_name""",
)(
    lambda i: M.evaluate(
        with_dims(i.t, "fact_test_run", {"dim_program": ["program_name"], **pages.SQUAD}),
        ["program_name", "squad_name"],
        M.run_measures(),
    )
)
query(
    "m5_pass_rate_month_over_month",
    """WITH monthly AS (SELECT CAST(date_trunc('month', started_at) AS DATE) AS month_start, count(*) AS n,
                             count(*) FILTER (run_status = 'PASS') AS p FROM fact_test_run GROUP BY ALL),
            rated AS (SELECT month_start, {ratio:p,n} AS pass_rate FROM monthly),
            joined AS (SELECT a.month_start, a.pass_rate, coalesce(b.pass_rate, 0.0) AS pass_rate_prior,
                              a.pass_rate - coalesce(b.pass_rate, 0.0) AS pass_rate_change,
                              round(CAST(a.pass_rate - coalesce(b.pass_rate, 0.0) AS DECIMAL(18, 6)), 1) AS d
                       FROM rated a LEFT JOIN rated b ON b.month_start = a.month_start - INTERVAL 1 MONTH)
       SELECT month_start, pass_rate, pass_rate_prior, pass_rate_change,
              CASE WHEN pass_rate_change >= 0 THEN '+' ELSE '' END || CAST(d AS DECIMAL(18, 1)) || '%' AS change_formatted,
              CASE WHEN pass_rate_change >= 0 THEN '▲ ' ELSE '▼ ' END || CAST(abs(d) AS DECIMAL(18, 1)) || '%' AS change_arrow
       FROM joined""",
)(lambda i: pages.monthly_change(i.t))
query(
    "m8_automation_by_type_lookup",
    """SELECT release_name, count(*) FILTER (test_type_name IS DISTINCT FROM 'Manual') AS automated_runs,
              {ratio:automated_runs,count(*)} AS automation_ratio FROM run_squad GROUP BY release_name""",
)(lambda i: pages.automation_by_type(i.t))
query(
    "m9_defect_measures_by_squad",
    """SELECT squad_name, count(*) AS total_defects,
              count(*) FILTER (coalesce(status, '') NOT IN ('Closed', 'Done', 'Resolved', 'Won''t Fix')) AS open_defects,
              count(*) FILTER (severity = 'Critical' OR priority IN ('P0', 'P1', 'Highest')) AS critical_defects,
              count(*) FILTER (severity = 'Critical' AND status IS DISTINCT FROM 'Closed') AS open_critical_defects,
              {ratio:count(*) FILTER (status IN ('Closed', 'Done', 'Resolved')),count(*)} AS resolution_rate
       FROM dim_defect LEFT JOIN dim_squad USING (squad_sk) GROUP BY squad_name""",
)(lambda i: M.evaluate(with_dims(i.t, "dim_defect", pages.SQUAD), ["squad_name"], M.defect_measures()))
query(
    "m11_defect_age",
    """SELECT defect_key, priority, created_at, datediff('day', CAST(created_at AS DATE), DATE '2001-12-31') AS age_days
       FROM dim_defect""",
)(lambda i: pages.defect_age(i.t, F.lit(date(2001, 12, 31))))
query(
    "m11_new_defects_month_to_date",
    """SELECT day, defects, CAST(sum(defects) OVER (PARTITION BY date_trunc('month', day) ORDER BY day) AS BIGINT) AS defects_mtd
       FROM (SELECT CAST(created_at AS DATE) AS day, count(*) AS defects FROM dim_defect GROUP BY ALL)""",
)(lambda i: pages.new_defects_month_to_date(i.t))
SNAPSHOT = """
    {ratio:sum(passed_tests),sum(executed_tests)} AS @pass_rate,
    {ratio:sum(covered_requirements),sum(total_requirements)} AS @coverage,
    {ratio:sum(automated_executions),sum(executed_tests)} AS @automation_rate,
    CAST(sum(open_critical_defects) AS BIGINT) AS @open_critical_defects"""
query(
    "m12_snapshot_measures_by_squad",
    "SELECT squad_name, " + SNAPSHOT.replace("@", "snapshot_") + " FROM fact_cycle_snapshot GROUP BY squad_name",
)(
    lambda i: M.evaluate(
        with_dims(with_snapshot(i.t), "fact_cycle_snapshot", pages.SQUAD), ["squad_name"], M.snapshot_measures()
    )
)
query(
    "m13_defect_link_measures_by_release",
    """SELECT release_name, count(*) AS total_defect_links, count(*) FILTER (open_flag) AS open_defects_linked,
              count(DISTINCT defect_key) AS unique_defects, count(DISTINCT test_run_id) AS impacted_test_runs
       FROM fact_defect_link GROUP BY release_name""",
)(lambda i: M.evaluate(with_dims(i.t, "fact_defect_link", pages.RELEASE), ["release_name"], M.link_measures()))
query(
    "m14_coverage_measures_by_squad",
    """SELECT squad_name, count(DISTINCT issue_sk) AS total_requirements,
              count(DISTINCT issue_sk) FILTER (is_covered) AS covered_requirements,
              total_requirements - covered_requirements AS uncovered_requirements,
              {ratio:covered_requirements,total_requirements} AS coverage
       FROM fact_requirement_coverage JOIN dim_issue USING (issue_sk) LEFT JOIN dim_squad USING (squad_sk)
       GROUP BY squad_name""",
)(lambda i: M.evaluate(with_dims(i.t, "fact_requirement_coverage", pages.SQUAD), ["squad_name"], M.coverage_measures()))
query(
    "m15_p1_measures_by_status",
    """SELECT release_status, CAST(sum(total_runs) AS BIGINT) AS p1_total_runs, CAST(sum(passed) AS BIGINT) AS p1_passed,
              CAST(sum(failed) AS BIGINT) AS p1_failed, CAST(sum(blocked) AS BIGINT) AS p1_blocked,
              {ratio:sum(passed),sum(total_runs)} AS p1_pass_rate,
              {ratio:sum(automated_runs),sum(total_runs)} AS p1_automation_rate FROM v1 GROUP BY release_status""",
)(lambda i: M.evaluate(marts.v1_qa_health_by_release(i.t), ["release_status"], M.p1_measures()))
query(
    "m17_etmi_by_release",
    """WITH parts AS (SELECT release_name, count(*) AS p1_total_runs,
                             {ratio:count(*) FILTER (run_status = 'PASS'),count(*)} AS p1_pass_rate,
                             {ratio:count(*) FILTER (is_automated),count(*)} AS automation_coverage,
                             {ratio:count(*) FILTER (is_automated AND test_type_name = 'Regression'),count(*) FILTER (test_type_name = 'Regression')}
                                 AS regression_automation
                      FROM run_squad GROUP BY release_name),
            scored AS (SELECT *, p1_pass_rate AS execution_efficiency,
                              automation_coverage / 100.0 * 40 + regression_automation / 100.0 * 30 + p1_pass_rate / 100.0 * 30
                                  AS etmi_score FROM parts)
       SELECT *, CASE WHEN etmi_score >= 75 THEN 'Mature' WHEN etmi_score >= 50 THEN 'Developing' ELSE 'Emerging' END AS etmi_band,
              75.0 AS etmi_target, CASE WHEN etmi_score >= 75 THEN 'On Track' ELSE 'At Risk' END AS etmi_status FROM scored""",
)(lambda i: pages.etmi_by_release(i.t))
FEW = ("T-1", "T-2", "T-7", "T-8", "T-13")
query(
    "m16_regression_automation_under_a_test_filter",
    """WITH page AS (SELECT release_name, count(*) AS p1_total_runs FROM run_squad WHERE test_key IN ('T-1', 'T-2', 'T-7', 'T-8', 'T-13') GROUP BY 1),
            every AS (SELECT release_name, {ratio:count(*) FILTER (is_automated AND test_type_name = 'Regression'),count(*) FILTER (test_type_name = 'Regression')}
                                               AS regression_automation FROM run_squad GROUP BY 1)
       SELECT release_name, p1_total_runs, regression_automation FROM page JOIN every USING (release_name)""",
)(
    lambda i: pages.etmi_by_release(apply_context(i.t, Context(tests=FEW)), unfiltered=i.t).select(
        "release_name", "p1_total_runs", "regression_automation"
    )
)
query(
    "m18_p2_measures_by_severity",
    """SELECT severity, CAST(sum(total_defects) AS BIGINT) AS p2_total_defects, CAST(sum(open_defects) AS BIGINT) AS p2_open_defects,
              CAST(sum(critical_defects) AS BIGINT) AS p2_critical_defects, CAST(sum(impacted_runs) AS BIGINT) AS p2_impacted_runs
       FROM v2 GROUP BY severity""",
)(lambda i: pages.defects_by(i.t, "severity"))
query(
    "m19_p3_measures_by_business_area",
    """SELECT business_area, count(DISTINCT issue_key) AS p3_total_requirements,
              count(DISTINCT issue_key) FILTER (is_covered) AS p3_covered_requirements,
              {ratio:p3_covered_requirements,p3_total_requirements} AS p3_coverage FROM v3 GROUP BY business_area""",
)(lambda i: M.evaluate(marts.v3_requirement_coverage(i.t), ["business_area"], M.p3_measures()))


def rounded(df, *columns):
    """Means of means depend on the order of summation in their last digits."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


query(
    "m20_p4_measures_by_year",
    """SELECT year, CAST(sum(total_runs) AS BIGINT) AS p4_total_runs, CAST(sum(passed) AS BIGINT) AS p4_passed,
              CAST(sum(failed) AS BIGINT) AS p4_failed, round(avg(avg_duration_s), 6) AS p4_avg_duration_s
       FROM v4 GROUP BY year""",
)(lambda i: rounded(M.evaluate(marts.v4_execution_trend(i.t), ["year"], M.p4_measures()), "p4_avg_duration_s"))
query(
    "m21_p5_measures_by_type",
    """SELECT test_type_name, CAST(sum(total_runs) AS BIGINT) AS p5_total_runs, CAST(sum(passed) AS BIGINT) AS p5_passed,
              CAST(sum(failed) AS BIGINT) AS p5_failed, round(avg(CAST(pass_rate_pct AS DOUBLE)), 6) AS p5_pass_rate
       FROM v5 GROUP BY test_type_name""",
)(lambda i: rounded(pages.type_measures(i.t), "p5_pass_rate"))
query(
    "m22_p7_measures_by_environment",
    """SELECT environment_name, CAST(sum(total_runs) AS BIGINT) AS p7_total_runs, CAST(sum(failed_runs) AS BIGINT) AS p7_failed_runs,
              CAST(sum(blocked_runs) AS BIGINT) AS p7_blocked_runs,
              {ratio:(p7_total_runs - p7_failed_runs - p7_blocked_runs),p7_total_runs} AS p7_pass_rate
       FROM v7 GROUP BY environment_name""",
)(lambda i: M.evaluate(marts.v7_environment_health(i.t), ["environment_name"], M.p7_measures()))
query(
    "m23_p8_measures_by_release_status",
    "SELECT release_status, " + SNAPSHOT.replace("@", "p8_") + " FROM v8 GROUP BY release_status",
)(lambda i: M.evaluate(marts.v8_release_snapshot(with_snapshot(i.t)), ["release_status"], M.p8_measures()))
query(
    "m24_governance_averages",
    """SELECT round(avg(CAST(defect_leakage_rate_pct AS DOUBLE)), 6) AS qm_defect_leakage_rate,
              round(avg(CAST(defect_removal_efficiency_pct AS DOUBLE)), 6) AS qm_defect_removal_efficiency,
              round(avg(CAST(requirements_without_tests_pct AS DOUBLE)), 6) AS qm_requirements_without_tests,
              round(avg(CAST(failed_runs_without_defect_pct AS DOUBLE)), 6) AS qm_failed_runs_without_defect,
              round(avg(CAST(avg_resolution_hours AS DOUBLE)), 6) AS qm_avg_resolution_hours FROM v9""",
)(lambda i: rounded(pages.governance_kpis(i.t), *M.qm_measures()))
query(
    "m25_release_readiness",
    "WITH s AS (SELECT 20011231 AS snapshot_date_sk, release_name, "
    + SNAPSHOT.replace("@", "snapshot_")
    + """ FROM fact_cycle_snapshot GROUP BY release_name)
       SELECT *, round(snapshot_pass_rate * 0.40 + snapshot_coverage * 0.30 + snapshot_automation_rate * 0.10, 1)
                 AS readiness_index FROM s""",
)(lambda i: pages.release_readiness(with_snapshot(i.t)))
query(
    "m26_defect_density",
    """SELECT r.release_name, coalesce(d.n, 0) AS defects, coalesce(c.n, 0) AS requirements,
              coalesce(CAST(d.n AS DOUBLE) / c.n, 0) AS defect_density
       FROM dim_release r
       LEFT JOIN (SELECT release_name, count(DISTINCT defect_key) AS n FROM fact_defect_link GROUP BY ALL) d USING (release_name)
       LEFT JOIN (SELECT release_name, count(DISTINCT issue_sk) AS n FROM fact_requirement_coverage GROUP BY ALL) c USING (release_name)""",
)(lambda i: pages.defect_density(i.t))
query(
    "m27_coverage_labels",
    """SELECT issue_key, release_name, CASE WHEN passing_test_count = 0 THEN 'Yes' ELSE 'No' END AS is_uncovered,
              CASE coverage_status WHEN 'PASS' THEN '✓ Covered' WHEN 'FAIL' THEN '✗ Failing' WHEN 'BLOCKED' THEN '⚠ Blocked'
                   WHEN 'TODO' THEN '○ Planned' WHEN 'EXECUTING' THEN '↻ Executing' ELSE '— Not Covered' END AS label
       FROM v3""",
)(
    lambda i: marts.v3_requirement_coverage(i.t)
    .groupBy("issue_key", "release_name", "passing_test_count")
    .agg(M.coverage_status_label().alias("label"))
    .withColumn("is_uncovered", M.is_uncovered(F.col("passing_test_count")))
    .drop("passing_test_count")
)
LIMITS = ", ".join(f"('{m}', {str(h).lower()}, {g}, {r})" for m, h, g, r in M.RAG_LIMITS)
query(
    "m28_governance_rag",
    f"""SELECT release_name, metric, value,
               CASE WHEN (high AND value >= green) OR (NOT high AND value <= green) THEN 'Green'
                    WHEN (high AND value < red) OR (NOT high AND value > red) THEN 'Red'
                    WHEN value IS NOT NULL THEN 'Amber' END AS rag
        FROM (SELECT release_name, unnest([{', '.join(repr(m) for m, *_ in M.RAG_LIMITS)}]) AS metric,
                     unnest([{', '.join(f'CAST({m} AS DOUBLE)' for m, *_ in M.RAG_LIMITS)}]) AS value FROM v9)
        JOIN (SELECT * FROM (VALUES {LIMITS}) x(metric, high, green, red)) USING (metric)""",
)(lambda i: pages.governance_rag(i.t))

DAILY = """daily AS (SELECT CAST(started_at AS DATE) AS day, count(*) AS n, count(*) FILTER (run_status = 'PASS') AS p
                     FROM fact_test_run GROUP BY ALL)"""


def trailing_sql(days: int) -> str:
    span = f"OVER (ORDER BY day RANGE BETWEEN INTERVAL {days - 1} DAY PRECEDING AND CURRENT ROW)"
    return f"""WITH {DAILY}
        SELECT day, CAST(sum(n) {span} AS BIGINT) AS total_runs_trailing, CAST(sum(p) {span} AS BIGINT) AS passed_trailing,
               {{ratio:passed_trailing,total_runs_trailing}} AS pass_rate FROM daily"""


query("w4_trailing_7_days", trailing_sql(7))(lambda i: pages.trailing_runs(i.t, 7))
query("w4_trailing_28_days", trailing_sql(28))(lambda i: pages.trailing_runs(i.t, 28))
query("m29_sprint_pass_rate", trailing_sql(14))(lambda i: pages.trailing_runs(i.t, 14))
query(
    "w1_latest_run_per_test",
    """SELECT test_sk, started_at, test_run_id, run_status, l_extendedprice FROM (SELECT *, row_number() OVER (
           PARTITION BY test_sk ORDER BY started_at DESC, test_run_id DESC, l_extendedprice DESC) AS n FROM fact_test_run) WHERE n = 1""",
)(
    lambda i: windows.latest(
        i.derived.runs().select("test_sk", "started_at", "test_run_id", "run_status", "l_extendedprice"),
        ["test_sk"],
        ["started_at", "test_run_id", "l_extendedprice"],
    )
)
query(
    "w5_run_sequence",
    """SELECT test_run_id, run_status, l_extendedprice, row_number() OVER (PARTITION BY test_sk ORDER BY started_at, test_run_id,
              l_extendedprice) AS run_sequence FROM fact_test_run""",
)(
    lambda i: windows.run_sequence(
        i.derived.runs(), ["test_sk"], "started_at", ["test_run_id", "l_extendedprice"]
    ).select("test_run_id", "run_status", "l_extendedprice", "run_sequence")
)
query(
    "j10_role_playing_dates",
    """SELECT c.issue_sk, c.release_name, d.full_date AS covered_full_date, d.year AS covered_year, d.month AS covered_month,
              d.week_of_year AS covered_week_of_year, r.full_date AS released_full_date, r.year AS released_year,
              r.month AS released_month, r.week_of_year AS released_week_of_year
       FROM fact_requirement_coverage c JOIN dim_release rel ON rel.release_name = c.release_name
       LEFT JOIN dim_date d ON d.date_sk = c.latest_execution_date_sk LEFT JOIN dim_date r ON r.full_date = rel.release_date""",
)(
    lambda i: with_date(
        i.t,
        with_date(
            i.t,
            with_dims(
                i.t, "fact_requirement_coverage", {"dim_release": ["release_name", "release_date_sk"]}, "inner"
            ),
            "latest_execution_date_sk",
            "covered",
        ),
        "release_date_sk",
        "released",
    ).select(
        "issue_sk",
        "release_name",
        *[f"{role}_{c}" for role in ("covered", "released") for c in ("full_date", "year", "month", "week_of_year")],
    )
)

# --- totals of distinct counts from parts -----------------------------------------


def link_totals(i):
    """Links by release and severity with all totals; the links are read once, by month."""
    links = with_dims(i.t, "fact_defect_link", {**pages.RELEASE, "dim_defect": ["severity"]})
    links = links.select("release_name", "severity", "defect_sk", "test_run_id", "open_flag", F.substring("test_run_id", -8, 6).alias("month_linked"))
    rows = distinct.coded(cut(links), "test_run_id", "run_code")
    counted = {"total_defect_links": F.lit(1), "open_defects_linked": F.col("open_flag").cast("int")}
    cells = distinct.parts(rows, ["month_linked", "release_name", "severity"], {"unique_defects": F.col("defect_sk"), "impacted_test_runs": F.col("run_code")}, counted)
    return distinct.totals(cells, ["release_name", "severity"], ["total_defect_links", "open_defects_linked", "unique_defects", "impacted_test_runs"])


query(
    "m13_link_matrix_totals",
    """SELECT release_name, severity, CAST(GROUPING(release_name, severity) AS INT) AS level, count(*) AS total_defect_links,
              count(*) FILTER (open_flag) AS open_defects_linked, count(DISTINCT l.defect_key) AS unique_defects, count(DISTINCT test_run_id) AS impacted_test_runs
       FROM fact_defect_link l JOIN dim_defect d ON d.defect_key = l.defect_key GROUP BY CUBE (release_name, severity)""",
)(link_totals)


def coverage_totals(rows, by, key, names):
    """Requirements and covered ones for every cell and total of two columns."""
    total, covered = names[:2]
    cells = distinct.parts(rows, by, {total: F.col(key), covered: F.when(F.col("is_covered"), F.col(key))})
    found = distinct.totals(cells, by, [total, covered])
    return found.withColumn(names[2], M.percent(F.col(covered), F.col(total)))


query(
    "m14_coverage_matrix_totals",
    """SELECT squad_name, release_name, CAST(GROUPING(squad_name, release_name) AS INT) AS level, count(DISTINCT issue_sk) AS total_requirements,
              count(DISTINCT issue_sk) FILTER (is_covered) AS covered_requirements, {ratio:covered_requirements,total_requirements} AS coverage
       FROM fact_requirement_coverage JOIN dim_issue USING (issue_sk) LEFT JOIN dim_squad USING (squad_sk) GROUP BY CUBE (squad_name, release_name)""",
)(
    lambda i: coverage_totals(
        with_dims(i.t, "fact_requirement_coverage", {**pages.SQUAD, **pages.RELEASE}),
        ["squad_name", "release_name"],
        "issue_sk",
        ["total_requirements", "covered_requirements", "coverage"],
    )
)
query(
    "m19_requirement_matrix_totals",
    """SELECT business_area, release_name, CAST(GROUPING(business_area, release_name) AS INT) AS level, count(DISTINCT issue_key) AS p3_total_requirements,
              count(DISTINCT issue_key) FILTER (is_covered) AS p3_covered_requirements, {ratio:p3_covered_requirements,p3_total_requirements} AS p3_coverage
       FROM v3 GROUP BY CUBE (business_area, release_name)""",
)(
    lambda i: coverage_totals(
        distinct.coded(cut(marts.v3_requirement_coverage(i.t).select("business_area", "release_name", "issue_key", "is_covered")), "issue_key", "issue_code"),
        ["business_area", "release_name"],
        "issue_code",
        ["p3_total_requirements", "p3_covered_requirements", "p3_coverage"],
    )
)
