"""Landed page dumps to staging records.

A page is one JSON response of the issue tracker or the test management tool. Pages are read as
text, parsed once to VARIANT and exploded; records keep their payload as JSON text.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qualitymart import schemas as S
from qualitymart.functions import scalars as X

# Response roots of the cloud variant.
CLOUD_ROOTS = {
    "xray_test": "getTests",
    "xray_test_execution": "getTestExecutions",
    "xray_test_plan": "getTestPlans",
    "xray_test_run": "getTestRuns",
}


def read_pages(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """Pages (body, origin) under a folder: one page per file, or per line."""
    text = spark.read.option("recursiveFileLookup", True).text(path, wholetext=not per_line)
    return text.select(F.col("value").alias("body"), F.col("_metadata.file_path").alias("origin"))


def _parsed(pages: DataFrame) -> DataFrame:
    return pages.select("origin", F.explode(X.parsed_values("body")).alias("page"))


def bad_pages(pages: DataFrame) -> DataFrame:
    """Pages that are not JSON."""
    return pages.where(X.parse_json("body").isNull()).select(
        F.col("origin").alias("source"), F.lit("bad_json").alias("reason"), "body"
    )


def _records(
    rows: DataFrame, run_id: str, loaded_at: datetime | Column, key: Column, entity: Column, payload: Column
) -> DataFrame:
    when = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)
    return rows.select(
        F.lit(run_id).alias("run_id"),
        F.coalesce(key, F.lit("")).alias("source_key"),
        entity.alias("entity_type"),
        payload.alias("raw_json"),
        when.cast("timestamp").alias("loaded_at"),
    )


def _augmented(item: Column, **added: Column) -> Column:
    """The payload object as JSON text with extra keys, which win over keys of the same name.

    The extra keys are appended as text: Spark writes strings that are VARIANT much slower than others.
    """
    fields = F.map_filter(F.try_variant_get(item, "$", "map<string,variant>"), lambda k, _: ~k.isin(*added))
    extra = F.to_json(F.create_map(*[c for name, value in added.items() for c in (F.lit(name), value.cast("string"))]))
    appended = lambda text: F.concat(
        F.left(text, F.length(text) - 1), F.when(text == "{}", "").otherwise(","), F.substring(extra, 2, 2**31 - 1)
    )
    return F.transform(F.array(F.to_json(fields)), appended)[0]


def _list_items(page: Column) -> Column:
    """Items of a page that is a bare list or has a ``results`` list."""
    return F.coalesce(X.items(page), X.items(page, "$.results"))


def _cloud_items(page: Column, root: str) -> Column:
    return X.items(page, f"$.data.{root}.results")


def updated_at(item: Column) -> Column:
    return X.parse_ts(X.text(item, "$.fields.updated"))


def issues(
    pages: DataFrame,
    run_id: str,
    loaded_at: datetime | Column,
    projects: Sequence[str] = (),
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """Issue records (S1); a Bug or Defect goes to the defect entity.

    ``since`` is cut to the minute in UTC and compared strictly (F2); ``until`` is inclusive.
    """
    item = F.col("item")
    rows = _parsed(pages).select(F.explode(X.items(F.col("page"), "$.issues")).alias("item"))
    if projects:
        rows = rows.where(project_of(X.text(item, "$.key")).isin(*projects))
    if since is not None:
        rows = rows.where(updated_at(item) > _wall_clock(since.replace(second=0, microsecond=0)))
    if until is not None:
        rows = rows.where(updated_at(item) <= _wall_clock(until))
    kind = X.text(item, "$.fields.issuetype.name").isin(*S.DEFECT_ISSUE_TYPES)
    entity = F.when(kind, "jira_defect").otherwise("jira_issue")
    return _records(rows, run_id, loaded_at, X.text(item, "$.key"), entity, F.to_json(item))


def _wall_clock(ts: datetime) -> Column:
    """A moment as UTC wall-clock time; one without zone is UTC already."""
    utc = ts.astimezone(timezone.utc).replace(tzinfo=None) if ts.tzinfo else ts
    return F.lit(utc.isoformat(sep=" ")).cast("timestamp_ntz")


def project_of(key: Column) -> Column:
    """Project part of an issue key."""
    return F.substring_index(key, "-", 1)


def newest_update(records: DataFrame) -> DataFrame:
    """Latest ``updated`` of the issue records, the next watermark."""
    issue = records.where(F.col("entity_type").isin("jira_issue", "jira_defect"))
    stamp = X.parse_ts(F.get_json_object("raw_json", "$.fields.updated"))
    return issue.agg(F.max(stamp).cast("timestamp").alias("watermark_after"))


def project_from_path(origin: Column) -> Column:
    """Project key of a landed versions page: the folder above the file."""
    return F.try_element_at(F.split(origin, "/"), F.lit(-2))


def versions(pages: DataFrame, run_id: str, loaded_at: datetime | Column, project: Column | None = None) -> DataFrame:
    """Version records (S2): bare lists, stamped with their project."""
    project = project if project is not None else project_from_path(F.col("origin"))
    item = F.col("item")
    rows = _parsed(pages).select(F.explode(X.items(F.col("page"))).alias("item"), project.alias("project"))
    payload = _augmented(item, _project_key=F.col("project"))
    key = F.coalesce(X.text(item, "$.id"), X.text(item, "$.name"))
    return _records(rows, run_id, loaded_at, key, F.lit("jira_version"), payload)


def server_entities(pages: DataFrame, entity: str, run_id: str, loaded_at: datetime | Column) -> DataFrame:
    """Tests, executions, sets or preconditions of the server variant (S3)."""
    item = F.col("item")
    rows = _parsed(pages).select(F.explode(_list_items(F.col("page"))).alias("item"))
    key = X.first_truthy(X.truthy_text(item, "$.key"), X.truthy_text(item, "$.id"), X.truthy_text(item, "$.issueId"))
    return _records(rows, run_id, loaded_at, key, F.lit(entity), F.to_json(item))


def cloud_entities(pages: DataFrame, entity: str, run_id: str, loaded_at: datetime | Column) -> DataFrame:
    """Tests, executions or plans of the cloud variant (S4), keyed like the tracker keys them.

    The issue key is preferred over the internal id, so that runs, which name the key, find their
    test. Sets and preconditions do not exist in this variant.
    """
    if entity not in CLOUD_ROOTS:
        return pages.sparkSession.createDataFrame([], S.STAGING)
    item = F.col("item")
    rows = _parsed(pages).select(F.explode(_cloud_items(F.col("page"), CLOUD_ROOTS[entity])).alias("item"))
    key = X.first_truthy(X.text(item, "$.jira.key"), X.text(item, "$.key"), X.text(item, "$.issueId"))
    return _records(rows, run_id, loaded_at, key, F.lit(entity), F.to_json(item))


def run_records(
    pages: DataFrame, run_id: str, loaded_at: datetime | Column, execution: Column | None = None, cloud: bool = False,
    only: str | None = None,
) -> DataFrame:
    """Run records and one record per step of each run, from one parse of the pages.

    ``execution`` is the execution the page belongs to, by default the folder above the file. Runs
    and steps are stamped with it; a step is keyed ``run:step``. With ``only`` an entity no rows are made of the other.
    """
    execution = execution if execution is not None else project_from_path(F.col("origin"))
    stamp = "_execution_issue_id" if cloud else "_execution_key"
    page, item, step = F.col("page"), F.col("item"), F.col("step")
    found = _cloud_items(page, CLOUD_ROOTS["xray_test_run"]) if cloud else _list_items(page)
    rows = _parsed(pages).select(F.explode(found).alias("item"), execution.alias("execution"))
    rows = rows.withColumn("run", X.first_truthy(X.text(item, "$.id"), X.text(item, "$.key")))
    # an item comes first without a step, for the run itself, then with each of its steps
    itself, steps = F.lit(None).cast("variant"), X.items(item, "$.steps")
    if only == "xray_test_run":
        rows = rows.withColumn("step", itself)
    elif only == "xray_test_step_result":
        # an element that is null would be taken for the run itself
        rows = rows.withColumn("step", F.explode(steps)).where(step.isNotNull())
    else:
        rows = rows.withColumn("step", F.explode(F.concat(F.array(itself), F.coalesce(steps, F.array().cast("array<variant>")))))
    is_run = step.isNull()
    run = F.coalesce("run", F.lit(""))
    key = F.when(is_run, F.col("run")).otherwise(F.concat_ws(":", run, F.coalesce(X.text(step, "$.id"), F.lit(""))))
    payload = F.when(is_run, _augmented(item, **{stamp: F.col("execution")})).otherwise(
        _augmented(step, **{"_test_run_id": run, stamp: F.col("execution")})
    )
    entity = F.when(is_run, "xray_test_run").otherwise("xray_test_step_result")
    return _records(rows, run_id, loaded_at, key, entity, payload)


def test_runs(
    pages: DataFrame, run_id: str, loaded_at: datetime | Column, execution: Column | None = None, cloud: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The records of ``run_records``, runs and steps apart; a load that takes both uses that."""
    return tuple(run_records(pages, run_id, loaded_at, execution, cloud, entity) for entity in ("xray_test_run", "xray_test_step_result"))
