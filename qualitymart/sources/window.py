"""A closed backfill window: records whose own time lies in it, and what they refer to."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitymart.functions import scalars as X
from qualitymart.functions.fieldmap import FieldMap
from qualitymart.operators import dims, facts
from qualitymart.session import cut, dealt, spread, stored
from qualitymart.sources import staging

#: Where a record states when it last changed, or started; before the paths, what a payload must contain to have any of them.
OWN_TIME = {"updated": ("$.fields.updated", "$.jira.updated", "$.updated"), "started": ("$.startedOn", "$.started_at")}
#: Entities that others refer to by key. They come along even if they changed outside of the window.
REFERRED = ("xray_test", "xray_test_execution", "xray_test_plan", "jira_defect", "jira_version")


def own_time() -> Column:
    """A record's own time; one that states none changed when it was landed."""
    # a payload is not parsed for keys whose letters it doesn't contain, unless some of its letters are escaped
    may_hold = lambda letters: F.contains("raw_json", F.lit(letters)) | F.contains("raw_json", F.lit("\\"))
    # through an array, since the text is used twice and would be looked up twice
    at = lambda path: F.transform(F.array(F.get_json_object("raw_json", path)), X.parse_ts)[0]
    stated = F.coalesce(*[F.when(may_hold(letters), F.coalesce(*map(at, paths))) for letters, paths in OWN_TIME.items()])
    return F.coalesce(stated.cast("timestamp"), F.col("loaded_at"))


def _name() -> Column:
    """What others call a record: a version by its name, all else by key."""
    return F.when(F.col("entity_type") == "jira_version", F.get_json_object("raw_json", "$.name")).otherwise(F.col("source_key"))


def _of(kept: DataFrame, entity: str) -> DataFrame:
    return staging.parse(kept.where(F.col("entity_type") == entity))


def _plans(kept: DataFrame, fields_map: FieldMap) -> DataFrame:
    """``entity, name`` of the plans that kept executions name."""
    executions = dims.executions(_of(kept, "xray_test_execution"), fields_map)
    return executions.select(F.lit("xray_test_plan").alias("entity"), F.col("test_plan_key").alias("name")).where("name IS NOT NULL").distinct()


def _referred(kept: DataFrame, fields_map: FieldMap) -> DataFrame:
    """``entity, name`` of everything that kept issues, executions and runs name; each payload is parsed once."""
    pair = lambda entity, name: F.struct(F.lit(entity).alias("entity"), name.alias("name"))
    none = F.array().cast("array<struct<entity: string, name: string>>")
    pairs = lambda entity, names: F.coalesce(F.transform(names, lambda name: pair(entity, name)), none)
    runs = facts.runs_of(kept.where("entity_type = 'xray_test_run'"), "test_key", "execution_key", "versions", "defects")
    issues = dims.issues(_of(kept, "jira_issue"), fields_map)
    of_run = F.concat(
        F.array(pair("xray_test", F.col("test_key")), pair("xray_test_execution", F.col("execution_key"))),
        pairs("jira_version", F.col("versions")),
        pairs("jira_defect", F.col("defects.defect_key")),
    )
    of_issue = F.concat(pairs("jira_version", F.col("fix_versions")), pairs("xray_test", F.col("linked_keys")))
    found = runs.select(F.inline(of_run)).union(issues.select(F.inline(of_issue))).where("name IS NOT NULL")
    return found.distinct().union(_plans(kept, fields_map))


def closed(records: DataFrame, since: datetime | None, until: datetime, fields_map: FieldMap) -> DataFrame:
    """Records changed after ``since`` and up to ``until``, closed over references.

    A run brings its test, execution, versions and defects, an issue its versions and linked tests, an execution its
    plan; a step comes with its run, whenever it was landed. An execution that a run brings brings its plan.
    """
    # stored, since four passes read them
    rows = stored(records.withColumns({"_time": own_time(), "_name": _name()}))
    inside = F.col("_time") <= F.lit(until)
    if since is not None:
        inside &= F.col("_time") > F.lit(since)
    is_step = F.col("entity_type") == "xray_test_step_result"
    # dealt out anew: the files that tasks read hold one entity each, of which many records or none are kept
    kept = cut(spread(rows.where(inside & ~is_step).select(*records.columns)))

    def named(wanted: DataFrame, entities: Sequence[str] = REFERRED) -> DataFrame:
        on = (F.col("entity_type") == F.col("entity")) & (F.col("_name") == F.col("name"))
        referred = rows.where(F.col("entity_type").isin(*entities) & ~inside)
        return referred.join(dealt(wanted), on, "left_semi").select(*records.columns)

    brought = cut(named(_referred(kept, fields_map)))
    # what they name in turn: plans of executions; the rest has been named before or lies in the window
    later = _plans(brought, fields_map)
    plans = named(later, ["xray_test_plan"]).join(brought.select("entity_type", "source_key"), ["entity_type", "source_key"], "left_anti").select(*records.columns)
    runs = dealt(kept.where("entity_type = 'xray_test_run'").select(F.col("source_key").alias("_run")).distinct())
    steps = rows.where(is_step).join(runs, F.get_json_object("raw_json", "$._test_run_id") == F.col("_run"), "left_semi")
    return kept.unionByName(brought).unionByName(plans).unionByName(steps.select(*records.columns))
