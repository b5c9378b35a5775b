"""Payloads to typed rows of the dimensions.

Every builder takes parsed staging rows (source_key, v, ord) and returns natural keys and values,
still carrying ``ord``; resolving keys and merging is left to the load plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualitymart.functions import scalars as X
from qualitymart.functions.fieldmap import FieldMap

V = "v"  # the payload column


def releases(parsed: DataFrame) -> DataFrame:
    """Versions with a name (B1)."""
    day = lambda a, b: X.parse_date(X.first_truthy(X.text(V, a), X.text(V, b)))
    flag = lambda path: X.truthy(X.node(V, path))
    release_date = day("$.releaseDate", "$.userReleaseDate")
    return parsed.select(
        X.truthy_text(V, "$.name").alias("release_name"),
        release_date.alias("release_date"),
        X.text(V, "$.description").alias("release_train"),
        day("$.startDate", "$.userStartDate").alias("planned_start_date"),
        release_date.alias("planned_end_date"),
        X.release_status(flag("$.released"), flag("$.archived"), flag("$.overdue")).alias("release_status"),
        X.date_to_sk(release_date).alias("release_date_sk"),
        "ord",
    ).where("release_name IS NOT NULL")


def issues(parsed: DataFrame, fields_map: FieldMap) -> DataFrame:
    """Requirements with the names of their program, application and squad (B2)."""
    rows = parsed.withColumn("f", F.coalesce(X.node(V, "$.fields"), F.parse_json(F.lit("{}"))))
    f = F.col("f")
    mapped = fields_map.fields("jira_issue", f)
    none = F.lit(None).cast("string")
    get = lambda name: mapped.get(name, none)
    application = X.unless_date(X.first_truthy(get("application_name"), X.first_component(f)))
    priority = F.coalesce(X.text(f, "$.priority.name"), F.lit(""))
    linked = lambda x: X.first_truthy(X.text(x, "$.outwardIssue.key"), X.text(x, "$.inwardIssue.key"))
    version = lambda x: X.object_or_scalar(x, "name")
    return rows.select(
        F.col("source_key").alias("issue_key"),
        X.text(f, "$.issuetype.name").alias("issue_type"),
        X.text(f, "$.summary").alias("summary"),
        X.text(f, "$.status.name").alias("status"),
        priority.alias("priority"),
        get("program_name").alias("program_name"),
        application.alias("application_name"),
        get("platform").alias("platform"),
        get("squad_name").alias("squad_name"),
        X.account(X.node(f, "$.reporter")).alias("reporter"),
        X.account(X.node(f, "$.assignee")).alias("assignee"),
        X.parse_ts(X.text(f, "$.created")).alias("created_at"),
        X.parse_ts(X.text(f, "$.updated")).alias("updated_at"),
        X.parse_ts(X.text(f, "$.resolutiondate")).alias("resolution_date"),
        X.critical_issue(priority).alias("critical_flag"),
        get("business_area").alias("business_area"),
        F.transform(X.items(f, "$.issuelinks"), linked).alias("linked_keys"),
        F.transform(X.items(f, "$.fixVersions"), version).alias("fix_versions"),
        "ord",
    )


def defects(parsed: DataFrame, fields_map: FieldMap) -> DataFrame:
    """Defects with the names of their squad and application."""
    rows = parsed.withColumn("f", X.node(V, "$.fields"))
    f = F.col("f")
    mapped = fields_map.fields("jira_defect", f)
    none = F.lit(None).cast("string")
    get = lambda name: mapped.get(name, none)
    severity = X.first_truthy(
        get("severity"),
        X.extract_select(X.node(f, "$.customfield_10204")),
        X.extract_select(X.node(f, "$.customfield_10010")),
    )
    priority = X.text(f, "$.priority.name")
    leaked = F.coalesce(X.truthy(X.node(f, "$.leakage_flag")), F.lit(False))
    return rows.select(
        F.col("source_key").alias("defect_key"),
        X.text(f, "$.summary").alias("summary"),
        X.text(f, "$.status.name").alias("status"),
        priority.alias("priority"),
        severity.alias("severity"),
        get("squad_name").alias("squad_name"),
        X.unless_date(X.first_truthy(get("application_name"), X.first_component(f))).alias("application_name"),
        X.account(X.node(f, "$.reporter")).alias("reporter"),
        X.account(X.node(f, "$.assignee")).alias("assignee"),
        X.parse_ts(X.text(f, "$.created")).alias("created_at"),
        X.parse_ts(X.text(f, "$.resolutiondate")).alias("resolved_at"),
        X.critical_defect(severity, priority).alias("critical_flag"),
        leaked.alias("leakage_flag"),
        get("root_cause").alias("root_cause"),
        "ord",
    )


def tests(parsed: DataFrame, fields_map: FieldMap) -> DataFrame:
    """Tests of either variant with the names of their type and squad."""
    rows = parsed.withColumn("f", X.envelope(V))
    f = F.col("f")
    mapped = fields_map.fields("xray_test", f)
    none = F.lit(None).cast("string")
    get = lambda name: mapped.get(name, none)
    return rows.select(
        F.col("source_key").alias("test_key"),
        X.text(f, "$.summary").alias("summary"),
        X.status_name(X.node(f, "$.status")).alias("status"),
        X.first_truthy(X.text(V, "$.testType.name"), get("test_type")).alias("test_type_name"),
        get("test_repository_path").alias("repository_path"),
        X.first_truthy(get("gherkin_definition"), X.text(V, "$.gherkin")).alias("gherkin_definition"),
        X.first_truthy(get("generic_definition"), X.text(V, "$.unstructured")).alias("generic_definition"),
        X.first_truthy(X.text(f, "$.squad_name"), get("squad_name")).alias("squad_name"),
        X.account(X.node(f, "$.assignee")).alias("assignee"),
        X.parse_ts(X.text(f, "$.created")).alias("created_at"),
        X.parse_ts(X.text(f, "$.updated")).alias("updated_at"),
        "ord",
    )


def executions(parsed: DataFrame, fields_map: FieldMap) -> DataFrame:
    """Test executions; environments stay a JSON list."""
    rows = parsed.withColumn("f", X.envelope(V))
    f = F.col("f")
    mapped = fields_map.fields("xray_test_execution", f)
    none = F.lit(None).cast("string")
    get = lambda name: mapped.get(name, none)
    raw = X.node(f, "$.customfield_10300")
    return rows.select(
        F.col("source_key").alias("execution_key"),
        X.text(f, "$.summary").alias("summary"),
        X.status_name(X.node(f, "$.status")).alias("status"),
        get("test_plan_key").alias("test_plan_key"),
        X.first_truthy(get("test_environments"), F.when(X.truthy(raw), X.text(raw))).alias("environments_json"),
        get("revision").alias("revision"),
        X.account(X.node(f, "$.assignee")).alias("assignee"),
        X.parse_ts(X.text(f, "$.updated")).alias("executed_at"),
        "ord",
    )


def environments(execution_rows: DataFrame) -> DataFrame:
    """Every environment an execution lists; the list is walked whole."""
    names = F.explode(X.items(X.parse_json("environments_json")))
    listed = execution_rows.select(names.alias("e"))
    e = F.col("e")
    name = F.when(X.is_object(e), X.first_truthy(X.text(e, "$.name"), X.text(e, "$.value"))).otherwise(X.text(e))
    return listed.select(name.alias("environment_name")).where("environment_name <> ''").distinct()


def plans(parsed: DataFrame, fields_map: FieldMap) -> DataFrame:
    """Test plans."""
    rows = parsed.withColumn("f", X.envelope(V))
    f = F.col("f")
    squad = X.first_truthy(fields_map.get("xray_test_plan", f, "squad_name"), X.text(f, "$.customfield_10201"))
    return rows.select(
        F.col("source_key").alias("test_plan_key"),
        X.text(f, "$.summary").alias("summary"),
        X.status_name(X.node(f, "$.status")).alias("status"),
        squad.alias("squad_name"),
        X.account(X.node(f, "$.assignee")).alias("assignee"),
        X.parse_ts(X.text(f, "$.created")).alias("created_at"),
        X.parse_ts(X.text(f, "$.updated")).alias("updated_at"),
        "ord",
    )
