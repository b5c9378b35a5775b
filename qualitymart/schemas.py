"""Table layouts of the star schema, as Spark DDL strings, and its fixed reference rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from qualitymart.session import no_rows

STAGING = "run_id STRING, source_key STRING, entity_type STRING, raw_json STRING, loaded_at TIMESTAMP"

# Entity types a staging record may carry.
ENTITY_TYPES = (
    "jira_issue",
    "jira_defect",
    "jira_version",
    "xray_test",
    "xray_test_execution",
    "xray_test_plan",
    "xray_test_run",
    "xray_test_step_result",
    "xray_test_set",
    "xray_precondition",
)

TABLES = {
    "dim_date": "date_sk INT, full_date DATE, year SMALLINT, quarter SMALLINT, month SMALLINT, month_name STRING,"
    " week_of_year SMALLINT, day_of_month SMALLINT, day_of_week SMALLINT, day_name STRING, is_weekend BOOLEAN,"
    " fiscal_year SMALLINT, fiscal_quarter SMALLINT",
    "dim_program": "program_sk BIGINT, program_name STRING, description STRING",
    "dim_application": "application_sk BIGINT, application_name STRING, platform STRING, program_sk BIGINT,"
    " is_active BOOLEAN",
    "dim_squad": "squad_sk BIGINT, squad_name STRING, program_sk BIGINT, application_sk BIGINT",
    "dim_release": "release_sk BIGINT, release_name STRING, release_date DATE, release_date_sk INT,"
    " release_train STRING, planned_start_date DATE, planned_end_date DATE, release_status STRING,"
    " is_released BOOLEAN",
    "dim_status": "status_sk BIGINT, status_name STRING, status_category STRING, sort_order SMALLINT",
    "dim_root_cause": "root_cause_sk BIGINT, root_cause_name STRING, root_cause_category STRING",
    "dim_environment": "environment_sk BIGINT, environment_name STRING, environment_type STRING, criticality STRING",
    "dim_tester": "tester_sk BIGINT, tester_id STRING, tester_name STRING, email STRING, team_name STRING,"
    " is_active BOOLEAN",
    "dim_test_type": "test_type_sk BIGINT, test_type_name STRING",
    "dim_issue": "issue_sk BIGINT, issue_key STRING, issue_type STRING, summary STRING, status STRING,"
    " priority STRING, program_sk BIGINT, squad_sk BIGINT, reporter STRING, assignee STRING,"
    " created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, resolution_date TIMESTAMP_NTZ, critical_flag BOOLEAN,"
    " business_area STRING",
    "dim_defect": "defect_sk BIGINT, defect_key STRING, summary STRING, status STRING, priority STRING,"
    " severity STRING, squad_sk BIGINT, application_sk BIGINT, reporter STRING, assignee STRING,"
    " created_at TIMESTAMP_NTZ, resolved_at TIMESTAMP_NTZ, resolution_date TIMESTAMP_NTZ, critical_flag BOOLEAN,"
    " leakage_flag BOOLEAN, root_cause STRING",
    "dim_test": "test_sk BIGINT, test_key STRING, summary STRING, status STRING, test_type_sk BIGINT,"
    " repository_path STRING, gherkin_definition STRING, generic_definition STRING, squad_sk BIGINT,"
    " assignee STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
    "dim_test_plan": "test_plan_sk BIGINT, test_plan_key STRING, summary STRING, status STRING, squad_sk BIGINT,"
    " assignee STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
    "dim_test_execution": "execution_sk BIGINT, execution_key STRING, summary STRING, status STRING,"
    " test_plan_key STRING, environments_json STRING, revision STRING, assignee STRING, executed_at TIMESTAMP_NTZ",
    "bridge_squad_user": "squad_sk BIGINT, user_email STRING, role STRING",
    "bridge_issue_test": "issue_key STRING, test_key STRING",
    "bridge_issue_release": "issue_key STRING, release_name STRING",
    "fact_test_run": "test_run_id STRING, release_sk BIGINT, test_sk BIGINT, execution_sk BIGINT,"
    " environment_sk BIGINT, tester_sk BIGINT, status_sk BIGINT, root_cause_sk BIGINT, date_sk INT,"
    " run_status STRING, run_sequence SMALLINT, is_automated BOOLEAN, is_blocked BOOLEAN, block_reason STRING,"
    " started_at TIMESTAMP_NTZ, finished_at TIMESTAMP_NTZ, duration_s DOUBLE, executed_by STRING, assignee STRING,"
    " comment STRING, defect_count INT, month INT",
    "fact_test_step_result": "step_result_id STRING, test_run_id STRING, step_order INT, step_status STRING,"
    " actual_result STRING, comment STRING, month INT",
    "fact_requirement_coverage": "issue_sk BIGINT, release_sk BIGINT, total_test_count BIGINT,"
    " passing_test_count BIGINT, failing_test_count BIGINT, blocked_test_count BIGINT,"
    " executing_test_count BIGINT, todo_test_count BIGINT, no_coverage_count INT, coverage_status STRING,"
    " partial_coverage_flag BOOLEAN, failed_coverage_flag BOOLEAN, latest_execution_date_sk INT, is_covered BOOLEAN",
    "fact_defect_link": "defect_key STRING, defect_sk BIGINT, test_run_id STRING, release_sk BIGINT,"
    " link_type STRING, open_flag BOOLEAN, linked_at TIMESTAMP_NTZ, month INT",
    "fact_cycle_snapshot": "snapshot_date_sk INT, release_sk BIGINT, squad_sk BIGINT, total_tests BIGINT,"
    " executed_tests BIGINT, passed_tests BIGINT, failed_tests BIGINT, blocked_tests BIGINT, not_run_tests BIGINT,"
    " automated_executions BIGINT, automated_executed BIGINT, covered_requirements BIGINT,"
    " total_requirements BIGINT, open_critical_defects BIGINT, avg_duration_s DOUBLE",
    "pipeline_watermarks": "job_name STRING, last_success_ts TIMESTAMP, updated_at TIMESTAMP, project STRING",
    "pipeline_run_log": "pipeline_run_id STRING, job_name STRING, status STRING, started_at TIMESTAMP,"
    " finished_at TIMESTAMP, records_extracted BIGINT, rows_processed BIGINT, rows_upserted BIGINT,"
    " watermark_before TIMESTAMP, watermark_after TIMESTAMP, error_message STRING, alert_sent BOOLEAN",
}

# What updates keep besides the star: per month what coverage and snapshot need of runs and links, and where the rows of a
# fact's keys are.
STATES = {
    "state_test_runs": "release_sk BIGINT, test_sk BIGINT, total_tests BIGINT, executed_tests BIGINT, passed_tests BIGINT,"
    " failed_tests BIGINT, blocked_tests BIGINT, not_run_tests BIGINT, automated_executions BIGINT,"
    " automated_executed BIGINT, duration_sum DOUBLE, duration_count BIGINT,"
    " last STRUCT<started_at: TIMESTAMP_NTZ, test_run_id: STRING, run_status: STRING, date_sk: INT>, month INT",
    "state_open_links": "release_sk BIGINT, defect_sk BIGINT, defect_key STRING, month INT",
    "month_of_run": "test_run_id STRING, month INT",
    "month_of_link": "test_run_id STRING, month INT",
    "month_of_step": "step_result_id STRING, month INT",
}

# Run statuses (name, category, sort order).
STATUSES = (
    ("PASS", "Pass", 1),
    ("FAIL", "Fail", 2),
    ("BLOCKED", "Blocked", 3),
    ("EXECUTING", "Active", 4),
    ("TODO", "Pending", 5),
    ("ABORTED", "Skipped", 6),
)

# Root causes (name, category).
ROOT_CAUSES = (
    ("Environment Outage", "Infra"),
    ("Environment Config", "Infra"),
    ("Test Data Missing", "Data"),
    ("Test Data Corrupt", "Data"),
    ("Application Bug", "App"),
    ("Application Config", "Config"),
    ("Network Timeout", "Network"),
    ("Build Failure", "Process"),
    ("Not Applicable", "N/A"),
)

# Vocabularies used by the derivation rules and the checks.
RUN_STATUSES = tuple(name for name, _, _ in STATUSES)
SEVERITIES = ("Critical", "High", "Medium", "Low")
DEFECT_ISSUE_TYPES = ("Bug", "Defect")
CLOSED_STATUSES = ("Closed", "Done", "Resolved", "Won't Fix")
RESOLVED_STATUSES = ("Closed", "Done", "Resolved")
CRITICAL_ISSUE_PRIORITIES = ("P0", "P1", "Highest", "Critical")
CRITICAL_DEFECT_PRIORITIES = ("P0", "P1", "Highest")
UNVERSIONED = "UNVERSIONED"
NO_ROOT_CAUSE = "Not Applicable"
LINK_TYPE = "Caused By"


def struct(table: str) -> StructType:
    return StructType.fromDDL(TABLES.get(table) or STATES[table])


def columns(table: str) -> list[str]:
    return struct(table).fieldNames()


def empty(spark: SparkSession, table: str) -> DataFrame:
    return no_rows(spark, struct(table))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project to the table layout; a column the frame lacks is NULL (additive schema evolution)."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in struct(table)
        ]
    )


def constant_rows(spark: SparkSession, rows: Iterable[tuple], columns: str) -> DataFrame:
    """A few fixed rows as SQL VALUES.

    Spark knows the size of such a relation and broadcasts it; rows handed over as a Python list have
    no known size, and a fact joined to them would be shuffled by their handful of keys.
    """
    text = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {text} AS fixed({columns})")


def status_seed(spark: SparkSession) -> DataFrame:
    seed = constant_rows(spark, STATUSES, "status_name, status_category, sort_order")
    return seed.withColumn("sort_order", F.col("sort_order").cast("smallint"))


def root_cause_seed(spark: SparkSession) -> DataFrame:
    return constant_rows(spark, ROOT_CAUSES, "root_cause_name, root_cause_category")
