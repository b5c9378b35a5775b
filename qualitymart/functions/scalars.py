"""Scalar rules (Column to Column) for payload fields, dates, ratios and labels.

Payload arguments are VARIANT columns (or their names). Everything is built from Spark's own
expressions, so a projection over a payload stays inside one code-generated stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from qualitymart import schemas as S

DECIMAL_PCT = "decimal(5,2)"


# --- payload access ---------------------------------------------------------


def node(v: Column, path: str) -> Column:
    """The value at ``path``, still as VARIANT; NULL if the path does not exist."""
    return F.try_variant_get(v, path, "variant")


def parsed_values(text: Column | str) -> Column:
    """Text as an array of its one JSON value, empty unless it is exactly one.

    Made to be exploded: that drops bad text and parses each text once, where a filter on the parsed
    value would be pushed below the projection and parse again. Spark's parser ignores whatever
    follows the first value; inside brackets it is a syntax error or a second element.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    only = lambda found: F.when(F.size(found) == 1, found[0])
    return F.array_compact(F.transform(F.array(items(listed)), only))


def parsed_as(text: Column | str, kind: str) -> Column:
    """Like ``parsed_values``, but each value cast to ``kind``, as a struct of ``v``; no VARIANT of the value is made,
    which would be a copy. A value that is something else than ``kind`` gives a NULL in the struct."""
    cast = lambda listed: F.when(
        F.size(F.try_variant_get(listed, "$", "array<struct<>>")) == 1, F.struct(F.try_variant_get(listed, "$[0]", kind).alias("v"))
    )
    return F.array_compact(F.transform(F.array(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))), cast))


def parse_json(text: Column | str) -> Column:
    """Text as VARIANT, NULL unless it is exactly one JSON value."""
    return F.try_element_at(parsed_values(text), F.lit(1))


def text(v: Column, path: str = "$") -> Column:
    """The value at ``path`` as text; NULL if absent, JSON null or not reachable."""
    return F.try_variant_get(v, path, "string")


def items(v: Column, path: str = "$") -> Column:
    """The JSON array at ``path`` as ARRAY<VARIANT>; NULL if it is not an array."""
    return F.try_variant_get(v, path, "array<variant>")


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def is_object(v: Column) -> Column:
    """Whether a JSON value is an object; a cast to no fields at all, which looks at nothing inside."""
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def truthy(v: Column) -> Column:
    """Whether a JSON value counts as set: not null, false, zero, empty text, list or object."""
    # an object by its number of members; the kind, which walks the whole value, only where the text may be an empty one
    members = F.size(F.try_variant_get(v, "$", "map<string,variant>"))
    kind, as_text = _kind(v), text(v)
    empty = (
        kind.isin("VOID", "OBJECT<>")
        | (as_text == "")
        | (as_text == "[]")
        | ((kind == "BOOLEAN") & (as_text == "false"))
        | ((kind == "BIGINT") & (as_text == "0"))
        | ((kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")) & as_text.rlike(r"^-?0(\.0*)?(E.*)?$"))
    )
    doubtful = as_text.isin("", "[]", "false") | as_text.rlike(r"^-?0(\.0*)?(E.*)?$")
    other = F.when(doubtful, ~empty).otherwise(as_text.isNotNull())
    return F.when(is_object(v), members > 0).otherwise(other)


def truthy_text(v: Column, path: str = "$") -> Column:
    """Text at ``path`` when the value there counts as set, else NULL."""
    found = node(v, path)
    return F.when(truthy(found), text(found))


def first_truthy(*values: Column) -> Column:
    """First text that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in values])


def object_or_scalar(v: Column, *keys: str) -> Column:
    """Text of a value that is either an object holding one of ``keys`` or a plain scalar."""
    inside = first_truthy(*[text(v, f"$.{k}") for k in keys]) if len(keys) > 1 else text(v, f"$.{keys[0]}")
    return F.when(is_object(v), inside).otherwise(text(v))


def account(v: Column) -> Column:
    """Display name (else account id) of a user object, or the scalar itself (C4)."""
    return object_or_scalar(v, "displayName", "accountId")


def extract_select(v: Column) -> Column:
    """Value of a select-list field."""
    return object_or_scalar(v, "value", "name")


def status_name(v: Column) -> Column:
    """Name of a status given as object or text (C14)."""
    return object_or_scalar(v, "name")


def first_component(v: Column, path: str = "$.components") -> Column:
    """Name of the first list element, or the element itself."""
    return object_or_scalar(node(v, f"{path}[0]"), "name")


def named_entry(entries: Column, *names: str) -> Column:
    """First entry of a ``customFields`` list with one of these names, ignoring case."""
    wanted = [n.lower() for n in names]
    return F.try_element_at(F.filter(entries, lambda x: F.lower(text(x, "$.name")).isin(*wanted)), F.lit(1))


def entry_value(entry: Column) -> Column:
    """Value of a custom field entry: ``value``, or the first of ``values``."""
    return F.coalesce(text(entry, "$.value"), text(entry, "$.values[0]"))


def custom_field(v: Column, *names: str) -> Column:
    """Value of a custom field by name (C11); the list may sit at the top or under ``test``."""
    found = lambda path: entry_value(named_entry(items(v, path), *names))
    return F.coalesce(found("$.customFields"), found("$.test.customFields"))


def envelope(v: Column) -> Column:
    """Where the tracker fields live: ``fields``, else ``jira``, else the root."""
    fields, jira = node(v, "$.fields"), node(v, "$.jira")
    return F.when(truthy(fields), fields).when(truthy(jira), jira).otherwise(node(v, "$"))


def first_environment(environments_json: Column) -> Column:
    """First environment named in a JSON list; malformed text gives NULL."""
    first = node(parse_json(environments_json), "$[0]")
    return F.nullif(F.when(is_object(first), first_truthy(text(first, "$.name"), text(first, "$.value"))).otherwise(
        text(first)
    ), F.lit(""))


# --- dates and durations ----------------------------------------------------


def parse_ts(value: Column) -> Column:
    """ISO text to a UTC wall-clock timestamp; no zone means UTC; anything else NULL."""
    iso = value.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}.*)?)?$")
    return F.when(iso, value.try_cast("timestamp")).cast("timestamp_ntz")


def parse_date(value: Column) -> Column:
    """Calendar date in the first ten characters, else NULL."""
    head = F.left(value, F.lit(10))
    dashed = F.regexp_replace(head, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return F.when(dashed.rlike(r"^\d{4}-\d{2}-\d{2}$"), dashed.try_cast("date"))


def date_to_sk(day: Column) -> Column:
    """Date as the integer yyyyMMdd."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def _epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def duration_s(start: Column, end: Column) -> Column:
    """Elapsed seconds, NULL unless both ends are known (C17)."""
    return (_epoch_micros(end) - _epoch_micros(start)) / F.lit(1e6)


def _boundaries(unit: str, start: Column, end: Column) -> Column:
    seconds = lambda c: F.unix_seconds(F.date_trunc(unit, c.cast("timestamp")))
    return seconds(end) - seconds(start)


def minute_boundaries_as_hours(start: Column, end: Column) -> Column:
    """Hours between two times, counted in whole minute boundaries crossed."""
    return (_boundaries("MINUTE", start, end) / 60).cast("bigint") / F.lit(60.0)


def second_boundaries(start: Column, end: Column) -> Column:
    """Second boundaries crossed between two times."""
    return _boundaries("SECOND", start, end)


# --- flags ------------------------------------------------------------------


def is_date_string(value: Column) -> Column:
    """Text that starts like a date."""
    return F.coalesce(value.rlike(r"^\d{4}[-/]\d{2}[-/]\d{2}"), F.lit(False))


def unless_date(value: Column) -> Column:
    return F.when(~is_date_string(value), value)


def release_status(released: Column, archived: Column, overdue: Column) -> Column:
    """Lifecycle label of a version from its three flags, first match wins."""
    return (
        F.when(released, "Released").when(archived, "On Hold").when(overdue, "In Progress").otherwise("Planning")
    )


def is_automated(test_type: Column) -> Column:
    """Anything not named manual counts as automated, also an unknown type."""
    return ~F.contains(F.lower(F.coalesce(test_type, F.lit(""))), F.lit("manual"))


def link_open_flag(defect_status: Column) -> Column:
    """Open unless the status is one of the closing ones; unknown is open (C20)."""
    closing = [s.lower() for s in S.CLOSED_STATUSES]
    return ~F.lower(F.coalesce(defect_status, F.lit(""))).isin(closing)


def critical_issue(priority: Column) -> Column:
    return F.coalesce(priority.isin(*S.CRITICAL_ISSUE_PRIORITIES), F.lit(False))


def critical_defect(severity: Column, priority: Column) -> Column:
    """Severity Critical or a top priority (P1c); NULL inputs give false."""
    return F.coalesce(severity == "Critical", F.lit(False)) | F.coalesce(
        priority.isin(*S.CRITICAL_DEFECT_PRIORITIES), F.lit(False)
    )


def is_executed(run_status: Column) -> Column:
    """Neither TODO nor EXECUTING; an unknown (NULL) status does not count."""
    return F.coalesce(~run_status.isin("TODO", "EXECUTING"), F.lit(False))


def is_open_defect(status: Column) -> Column:
    """Not in a closing status; a missing status is open."""
    return ~F.coalesce(status.isin(*S.CLOSED_STATUSES), F.lit(False))


def array_length(values: Column) -> Column:
    return F.coalesce(F.size(values), F.lit(0))


# --- ratios, labels, formatting --------------------------------------------


def pct(part: Column, whole: Column) -> Column:
    """Percentage as DECIMAL(5,2), NULL over zero."""
    exact = F.lit("100.0").cast("decimal(4,1)") * part.cast("decimal(18,0)") / F.nullif(
        whole.cast("decimal(18,0)"), F.lit(0)
    )
    return exact.try_cast(DECIMAL_PCT)


def divide(part: Column, whole: Column, alternate: Column | float | None = 0.0) -> Column:
    """Division with an alternate result over zero or blank."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double"))
    if alternate is None:
        return ratio
    return F.coalesce(ratio, alternate if isinstance(alternate, Column) else F.lit(float(alternate)))


def format_pct(value: Column) -> Column:
    """One decimal and a percent sign."""
    return F.concat(_one_decimal(value), F.lit("%"))


def format_change(value: Column) -> Column:
    """Signed change, a dash when unknown."""
    signed = F.concat(F.when(value >= 0, "+").otherwise(""), _one_decimal(value), F.lit("%"))
    return F.coalesce(signed, F.lit("-"))


def format_change_arrow(value: Column) -> Column:
    """Change with an up or down marker, a long dash when unknown."""
    marked = F.concat(
        F.when(value >= 0, "▲ ").otherwise("▼ "), _one_decimal(F.abs(value)), F.lit("%")
    )
    return F.coalesce(marked, F.lit("—"))


def _one_decimal(value: Column) -> Column:
    return F.round(value.cast("decimal(18,6)"), 1).cast("decimal(18,1)").cast("string")


def band(value: Column, steps: Sequence[tuple[float, str]], lowest: str) -> Column:
    """Label of the first threshold (given from high to low) the value reaches."""
    label = F.lit(lowest)
    for limit, name in reversed(steps):
        label = F.when(value >= limit, name).otherwise(label)
    return label


def status_vs_target(value: Column, target: float) -> Column:
    return F.when(value >= target, "On Track").otherwise("At Risk")


# Display label per coverage status.
COVERAGE_LABELS = (
    ("PASS", "✓ Covered"),
    ("FAIL", "✗ Failing"),
    ("BLOCKED", "⚠ Blocked"),
    ("TODO", "○ Planned"),
    ("EXECUTING", "↻ Executing"),
    ("NO_COVERAGE", "— Not Covered"),
)


def coverage_label(status: Column) -> Column:
    label = F.lit(dict(COVERAGE_LABELS)["NO_COVERAGE"])
    for name, shown in COVERAGE_LABELS:
        label = F.when(status == name, shown).otherwise(label)
    return label


def clip(value: Column, length: int) -> Column:
    """At most ``length`` characters, empty for NULL."""
    return F.left(F.coalesce(value, F.lit("")), F.lit(length))


def minute_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")
