"""Payloads to typed rows of the facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitymart import schemas as S
from qualitymart.functions import scalars as X
from qualitymart.operators import keys
from qualitymart.sources import staging
from qualitymart.sources.star import Star

V = "v"  # the payload column


# The parts of a run payload that are read, as one cast of the payload. Parts of varying shape stay VARIANT.
RUN_PAYLOAD = {
    "status": "variant",
    "startedOn": "string",
    "started_at": "string",
    "finishedOn": "string",
    "finished_at": "string",
    "assignee": "variant",
    "assigneeId": "string",
    "comment": "string",
    "blockReason": "string",
    "block_reason": "string",
    "defects": "array<variant>",
    "fixVersions": "array<variant>",
    "customFields": "array<variant>",
    "test": "struct<key: string, jira: variant, testType: variant, customFields: array<variant>>",
    "_execution_key": "string",
    "_execution_issue_id": "string",
}
# The parts that each column of a run is made of.
RUN_PARTS = {
    "test_run_id": (),
    "test_key": ("test",),
    "execution_key": ("_execution_key", "_execution_issue_id"),
    "tester_id": ("assignee", "assigneeId"),
    "tester_name": ("assignee",),
    "email": ("assignee",),
    "team_name": ("assignee",),
    "run_status": ("status",),
    "root_cause_name": ("customFields", "test"),
    "is_automated": ("test",),
    "block_reason": ("blockReason", "block_reason"),
    "started_at": ("startedOn", "started_at"),
    "finished_at": ("finishedOn", "finished_at"),
    "duration_s": ("startedOn", "started_at", "finishedOn", "finished_at"),
    "date_sk": ("startedOn", "started_at"),
    "executed_by": ("assignee", "assigneeId"),
    "comment": ("comment",),
    "defect_count": ("defects",),
    "versions": ("fixVersions", "test"),
    "defects": ("defects",),
    "ord": (),
}
STEP_PAYLOAD = (
    "struct<_test_run_id: string, index: variant, `order`: variant, status: variant, actualResult: string,"
    " actual_result: string, comment: string>"
)


def _names(values: Column) -> Column:
    """Version names of a list of objects or scalars; blanks are dropped."""
    return F.filter(F.transform(values, lambda x: X.object_or_scalar(x, "name")), lambda x: x.isNotNull() & (x != ""))


def _defects(values: Column) -> Column:
    """Linked defects as (key, open) pairs; an element may be an object or a bare key."""

    def pair(x: Column) -> Column:
        key = X.first_truthy(X.text(x, "$.jira.key"), X.text(x, "$.key"), X.text(x, "$.issueId"))
        return F.struct(
            F.when(X.is_object(x), key).otherwise(F.nullif(X.text(x), F.lit(""))).alias("defect_key"),
            X.link_open_flag(X.text(x, "$.jira.status.name")).alias("open_flag"),
        )

    return F.transform(F.coalesce(values, F.array().cast("array<variant>")), pair)


def runs(parsed: DataFrame, *columns: str) -> DataFrame:
    """One row per run, before the fan-out over versions (B6); all columns, or those named.

    In steps: cast the payload, pick the parts, derive the columns, so that nothing is worked out twice. The cast passes
    through a generator, so that a filter on the columns can't make Spark cast again; nor can it leave parts out there, so
    only those are cast of which the columns are made.
    """
    wanted = columns or tuple(RUN_PARTS)
    return _runs(parsed.select("source_key", "ord", F.explode(F.array(F.try_variant_get(V, "$", _run_layout(wanted)))).alias("p")), wanted)


def runs_of(records: DataFrame, *columns: str) -> DataFrame:
    """``runs`` of staging records; payloads are cast as they are parsed, without a VARIANT of each in between."""
    wanted = columns or tuple(RUN_PARTS)
    return _runs(staging.parse(records, _run_layout(wanted)).withColumnRenamed(V, "p"), wanted)


def _run_layout(wanted: Sequence[str]) -> str:
    read = {part for column in wanted for part in RUN_PARTS[column]}
    return f"struct<{', '.join(f'`{part}`: {kind}' for part, kind in RUN_PAYLOAD.items() if part in read)}>"


def _runs(cast: DataFrame, wanted: Sequence[str]) -> DataFrame:
    read = {part for column in wanted for part in RUN_PARTS[column]}
    parts = [(F.col(f"p.{part}") if part in read else F.lit(None).cast(kind)).alias(part) for part, kind in RUN_PAYLOAD.items()]
    picked = cast.select("source_key", "ord", *parts).select(
        "*",
        X.first_truthy(F.col("startedOn"), F.col("started_at")).alias("started_text"),
        X.first_truthy(F.col("finishedOn"), F.col("finished_at")).alias("finished_text"),
        X.is_object(F.col("assignee")).alias("person"),
        _names(F.col("fixVersions")).alias("own_versions"),
        _names(X.items(F.col("test.jira"), "$.fixVersions")).alias("test_versions"),
        X.named_entry(F.col("customFields"), "root_cause", "Root Cause").alias("cause"),
        X.named_entry(F.col("test.customFields"), "root_cause", "Root Cause").alias("test_cause"),
    )
    timed = picked.withColumns(
        {
            "started": X.parse_ts(F.col("started_text")),
            "finished": X.parse_ts(F.col("finished_text")),
            "display_name": F.when(F.col("person"), X.text("assignee", "$.displayName")),
        }
    )
    of_person = lambda *paths: F.when(F.col("person"), X.first_truthy(*[X.text("assignee", p) for p in paths]))
    versions = (
        F.when(F.size("own_versions") > 0, F.col("own_versions"))
        .when(F.size("test_versions") > 0, F.col("test_versions"))
        .otherwise(F.array(F.lit(S.UNVERSIONED)))
    )
    cause = F.coalesce(X.entry_value(F.col("cause")), X.entry_value(F.col("test_cause")))
    account = F.when(F.col("person"), X.first_truthy(F.col("display_name"), X.text("assignee", "$.accountId"))).otherwise(
        X.text("assignee")
    )
    return timed.select(
        F.col("source_key").alias("test_run_id"),
        X.first_truthy(X.text("test.jira", "$.key"), F.col("test.key")).alias("test_key"),
        X.first_truthy(F.col("_execution_key"), F.col("_execution_issue_id")).alias("execution_key"),
        X.first_truthy(of_person("$.accountId", "$.displayName"), F.col("assigneeId")).alias("tester_id"),
        F.col("display_name").alias("tester_name"),
        of_person("$.email", "$.emailAddress").alias("email"),
        F.when(F.col("person"), X.text("assignee", "$.teamName")).alias("team_name"),
        X.status_name("status").alias("run_status"),
        X.first_truthy(cause, F.lit(S.NO_ROOT_CAUSE)).alias("root_cause_name"),
        X.is_automated(X.text("test.testType", "$.name")).alias("is_automated"),
        X.first_truthy(F.col("blockReason"), F.col("block_reason")).alias("block_reason"),
        F.col("started").alias("started_at"),
        F.col("finished").alias("finished_at"),
        X.duration_s(F.col("started"), F.col("finished")).alias("duration_s"),
        # The day is the one the payload shows, in the payload's own offset.
        F.when(F.col("started").isNotNull(), X.date_to_sk(X.parse_date(F.col("started_text")))).alias("date_sk"),
        X.first_truthy(account, F.col("assigneeId")).alias("executed_by"),
        "comment",
        X.array_length(F.col("defects")).alias("defect_count"),
        F.array_distinct(versions).alias("versions"),
        _defects(F.col("defects")).alias("defects"),
        "ord",
    ).select(*wanted)


def testers(run_rows: DataFrame) -> DataFrame:
    return run_rows.where("tester_id IS NOT NULL").select("tester_id", "tester_name", "email", "team_name", "ord")


def month_of(date_sk: str = "date_sk") -> Column:
    """Month the fact is filed under; 0 for undated rows."""
    return F.coalesce((F.col(date_sk) / 100).cast("int"), F.lit(0))


def test_run_facts(run_rows: DataFrame, t: Star) -> DataFrame:
    """Run facts with surrogate keys, one per run and version.

    All lookups happen before the fan-out over versions; only the release is looked up after it.
    """
    environment = t["dim_test_execution"].withColumn("environment_name", X.first_environment(F.col("environments_json")))
    df = keys.lookup(run_rows, t["dim_test"], "test_key", "test_key", "test_sk", grows=True)
    df = keys.lookup(df, environment, "execution_key", "execution_key", "execution_sk", "environment_name", grows=True)
    df = keys.lookup(df, t["dim_environment"], "environment_name", "environment_name", "environment_sk")
    df = keys.lookup(df, t["dim_tester"], "tester_id", "tester_id", "tester_sk")
    df = keys.lookup(df, t["dim_status"], "run_status", "status_name", "status_sk")
    df = keys.lookup(df, t["dim_root_cause"], "root_cause_name", "root_cause_name", "root_cause_sk")
    df = df.withColumn("release_name", F.explode("versions"))
    df = keys.lookup(df, t["dim_release"], "release_name", "release_name", "release_sk")
    return df.withColumns(
        {
            "run_sequence": F.lit(1),
            "is_blocked": F.coalesce(F.col("run_status") == "BLOCKED", F.lit(False)),
            "month": month_of(),
        }
    )


def defect_links(run_rows: DataFrame, t: Star) -> DataFrame:
    """Links runs x versions x defects (B7); a link without a defect key is skipped."""
    pairs = run_rows.select(
        "test_run_id", month_of().alias("month"), "ord", "versions", F.explode("defects").alias("d")
    ).where("d.defect_key IS NOT NULL")
    fanned = pairs.select("test_run_id", "month", "ord", "d.*", F.explode("versions").alias("release_name"))
    df = keys.lookup(fanned, t["dim_release"], "release_name", "release_name", "release_sk")
    df = keys.lookup(df, t["dim_defect"].withColumnRenamed("defect_key", "_defect"), "defect_key", "_defect", "defect_sk", grows=True)
    return df.select(
        "defect_key", "defect_sk", "test_run_id", "release_sk", F.lit(S.LINK_TYPE).alias("link_type"), "open_flag", "month", "ord"
    )


def steps(parsed: DataFrame) -> DataFrame:
    """Step results (B8); the order is the index, else the order, else 0."""
    rows = parsed.select("source_key", "ord", F.try_variant_get(V, "$", STEP_PAYLOAD).alias("p")).select("source_key", "ord", "p.*")
    number = lambda c: X.truthy_text(F.col(c)).try_cast("int")
    return rows.select(
        F.col("source_key").alias("step_result_id"),
        F.coalesce("_test_run_id", F.lit("")).alias("test_run_id"),
        F.coalesce(number("index"), number("order"), F.lit(0)).alias("step_order"),
        X.status_name(F.col("status")).alias("step_status"),
        X.first_truthy(F.col("actualResult"), F.col("actual_result")).alias("actual_result"),
        "comment",
        "ord",
    )
