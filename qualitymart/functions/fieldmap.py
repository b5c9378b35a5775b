"""Custom-field map: which tracker field feeds which logical column, and how."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qualitymart.functions import scalars as X

MAP_SCHEMA = (
    "mappings ARRAY<STRUCT<source_field_id: STRING, logical_name: STRING, target_table: STRING,"
    " target_column: STRING, entity_type: STRING, field_type: STRING>>"
)


class FieldMapping(NamedTuple):
    source_field_id: str
    logical_name: str
    target_table: str
    target_column: str
    entity_type: str
    field_type: str = "string"


# The default field map.
DEFAULT_MAPPINGS = (
    FieldMapping("customfield_10200", "program_name", "dim_program", "program_name", "jira_issue", "string"),
    FieldMapping("customfield_10201", "squad_name", "dim_squad", "squad_name", "jira_issue", "string"),
    FieldMapping("customfield_10202", "application_name", "dim_application", "application_name", "jira_issue", "string"),
    FieldMapping("customfield_10203", "root_cause", "dim_root_cause", "root_cause_name", "jira_defect", "select_value"),
    FieldMapping("customfield_10204", "severity", "dim_defect", "severity", "jira_defect", "select_value"),
    FieldMapping("customfield_10205", "business_area", "dim_issue", "business_area", "jira_issue", "string"),
    FieldMapping("customfield_10100", "test_type", "dim_test", "test_type_sk", "xray_test", "select_value"),
    FieldMapping("customfield_10101", "test_repository_path", "dim_test", "repository_path", "xray_test", "string"),
    FieldMapping("customfield_10102", "manual_test_steps", "stg_xray_tests", "steps_json", "xray_test", "json"),
    FieldMapping("customfield_10103", "gherkin_definition", "dim_test", "gherkin_definition", "xray_test", "string"),
    FieldMapping("customfield_10104", "generic_definition", "dim_test", "generic_definition", "xray_test", "string"),
    FieldMapping(
        "customfield_10300", "test_environments", "dim_environment", "environment_name", "xray_test_execution", "array"
    ),
    FieldMapping(
        "customfield_10301", "test_plan_key", "stg_xray_test_executions", "test_plan_key", "xray_test_execution", "issue_key"
    ),
    FieldMapping("customfield_10302", "revision", "stg_xray_test_executions", "revision", "xray_test_execution", "string"),
)


def _as_string(v: Column) -> Column:
    return F.nullif(X.text(v), F.lit(""))


def _as_select_value(v: Column) -> Column:
    return X.object_or_scalar(v, "value")


def _as_array(v: Column) -> Column:
    """JSON list; an element that is an object with a ``value`` is replaced by it."""
    element = lambda x: F.coalesce(X.node(x, "$.value"), x)
    many = F.to_json(F.transform(X.items(v), element))
    return F.coalesce(many, F.when(X.text(v).isNotNull(), F.to_json(F.array(v))))


def _as_json(v: Column) -> Column:
    nested = X.is_object(v) | X.items(v).isNotNull()
    return F.when(nested, F.to_json(v)).otherwise(X.text(v))


def _as_issue_key(v: Column) -> Column:
    return X.object_or_scalar(v, "key")


COERCIONS: dict[str, Callable[[Column], Column]] = {
    "string": _as_string,
    "select_value": _as_select_value,
    "array": _as_array,
    "json": _as_json,
    "issue_key": _as_issue_key,
}


def coerce(v: Column, field_type: str) -> Column:
    """A mapped value as text; an unknown field type gives the plain text."""
    return COERCIONS.get(field_type, X.text)(v)


#: Member that a type looks for in an object.
MEMBERS = {"select_value": "value", "issue_key": "key"}


def coerce_checked(v: Column, field_type: str) -> Column:
    """``value, reason``: a mapped value as text, and why it may not be what was meant, or NULL.

    ``missing_member``: an object without the member its type looks for, which gives NULL; ``unknown_field_type``:
    a type that is not known, which gives the plain text.
    """
    reason = F.lit(None).cast("string")
    if field_type not in COERCIONS:
        reason = F.when(X.text(v).isNotNull(), "unknown_field_type")
    elif field_type in MEMBERS:
        reason = F.when(X.is_object(v) & X.text(v, f"$.{MEMBERS[field_type]}").isNull(), "missing_member")
    return F.struct(coerce(v, field_type).alias("value"), reason.alias("reason"))


class FieldMap:
    """The configured mappings; at most a few hundred rows, held on the driver."""

    def __init__(self, mappings: Iterable[FieldMapping] = DEFAULT_MAPPINGS):
        self.mappings = list(mappings)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FieldMap:
        """Read a map file; a missing file is an error."""
        raw = spark.read.schema(MAP_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path)
        rows = raw.select(F.inline("mappings")).collect()
        return cls(FieldMapping(*[r[f] if r[f] is not None else d for f, d in zip(FieldMapping._fields, ("",) * 5 + ("string",))]) for r in rows)

    def mappings_for(self, entity_type: str) -> list[FieldMapping]:
        return [m for m in self.mappings if m.entity_type == entity_type]

    def fields(self, entity_type: str, payload: Column) -> dict[str, Column]:
        """Logical name to extracted value, for every mapping of the entity type."""
        return {
            m.logical_name: coerce(X.node(payload, f"$.{m.source_field_id}"), m.field_type)
            for m in self.mappings_for(entity_type)
        }

    def get(self, entity_type: str, payload: Column, logical_name: str) -> Column:
        """One logical field; NULL when the map does not have it."""
        return self.fields(entity_type, payload).get(logical_name, F.lit(None).cast("string"))

    def columns(self, entity_type: str, payload: Column) -> list[Column]:
        return [c.alias(name) for name, c in self.fields(entity_type, payload).items()]

    def coercions(self, entity_type: str, parsed: DataFrame, payload: str = "v") -> DataFrame:
        """``source_key, logical_name, value, reason`` of every mapped field that a record sets, in one pass over the
        payloads; those with a reason are rejects, the others the values (C12, D16)."""
        mapped = self.mappings_for(entity_type)
        if not mapped:
            return parsed.sparkSession.createDataFrame([], "source_key STRING, logical_name STRING, value STRING, reason STRING")
        entry = lambda m: F.struct(F.lit(m.logical_name).alias("logical_name"), coerce_checked(X.node(F.col(payload), f"$.{m.source_field_id}"), m.field_type).alias("c"))
        rows = parsed.select("source_key", F.explode(F.array(*map(entry, mapped))).alias("e")).select("source_key", "e.logical_name", "e.c.*")
        return rows.where("value IS NOT NULL OR reason IS NOT NULL")

    def unknown_types(self, spark: SparkSession) -> DataFrame:
        """Mappings whose field type is not known; their values pass through as text."""
        bad = [m for m in self.mappings if m.field_type not in COERCIONS]
        return spark.createDataFrame([tuple(m) for m in bad], ", ".join(f"{f} STRING" for f in FieldMapping._fields))
