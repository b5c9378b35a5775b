"""Data-quality checks (D1 to D17): each returns the violating rows."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualitymart import schemas as S
from qualitymart.functions import scalars as X
from qualitymart.operators import windows
from qualitymart.plans import marts
from qualitymart.session import dealt
from qualitymart.sources.star import Star


def _blank(column: str) -> Column:
    return F.col(column).isNull() | (F.trim(F.col(column).cast("string")) == "")


def _moment(as_of: date | datetime) -> Column:
    return F.lit(as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else as_of.isoformat()).cast("timestamp_ntz")


def _days_before(as_of: date | datetime, days: int) -> Column:
    return _moment(as_of) - F.make_dt_interval(F.lit(days))


def tests_without_recent_run(t: Star, as_of: date, days: int = 30) -> DataFrame:
    """Tests with no run in the last days (D1): an anti-join bounded in time."""
    recent = t["fact_test_run"].where(F.col("started_at") >= _days_before(as_of, days)).select("test_sk")
    return t["dim_test"].join(recent, "test_sk", "left_anti").select("test_key", "summary")


def releases_without_pass(t: Star) -> DataFrame:
    """Releases with runs of which none passed."""
    health = marts.v1_qa_health_by_release(t)
    return health.where((F.col("total_runs") > 0) & (F.col("pass_rate_pct") == 0))


def failed_jobs(log: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Failed job runs of the last days (D3)."""
    return log.where((F.col("status") == "failed") & (F.col("started_at") >= _days_before(as_of, days)))


def last_jobs(log: DataFrame, n: int = 10, error_length: int = 400) -> DataFrame:
    """The newest job runs, shortened for display (D3)."""
    newest = log.orderBy(F.desc("started_at"), "pipeline_run_id").limit(n)
    return newest.select(
        "pipeline_run_id",
        "job_name",
        "status",
        X.minute_stamp(F.col("started_at")).alias("started"),
        X.minute_stamp(F.col("finished_at")).alias("finished"),
        X.second_boundaries(F.col("started_at"), F.col("finished_at")).alias("duration_s"),
        "records_extracted",
        "rows_upserted",
        X.clip(F.col("error_message"), error_length).alias("error"),
    )


def doubtful_watermarks(watermarks: DataFrame, as_of: datetime, hours: int = 8) -> DataFrame:
    """Watermarks that are stale or lie in the future."""
    stamp = F.col("last_success_ts").cast("timestamp_ntz")
    limit = _moment(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours))
    finding = F.when(stamp < limit, "stale").when(stamp > _moment(as_of), "future")
    return watermarks.select("job_name", "last_success_ts", finding.alias("finding")).where("finding IS NOT NULL")


# Tables the load check counts.
CENSUS = ("dim_date", "dim_release", "dim_test", "fact_test_run", "fact_requirement_coverage", "dim_defect")


def census(t: Star, tables: Iterable[str] = CENSUS) -> DataFrame:
    """Row count per table."""
    counts = [t[name].agg(F.count("*").alias("n")).select(F.lit(name).alias("tbl"), "n") for name in tables]
    total = counts[0]
    for one in counts[1:]:
        total = total.unionByName(one)
    return total


def date_like_applications(t: Star) -> DataFrame:
    return t["dim_application"].where(X.is_date_string(F.col("application_name"))).select("application_name")


def unknown_run_status(t: Star) -> DataFrame:
    """Runs whose status is not one of the six."""
    return t["fact_test_run"].where(~F.coalesce(F.col("run_status").isin(*S.RUN_STATUSES), F.lit(False))).select("test_run_id", "run_status")


def unknown_severity(t: Star) -> DataFrame:
    """Defects whose severity is set but not one of the four."""
    return t["dim_defect"].where(~F.col("severity").isin(*S.SEVERITIES)).select("defect_key", "severity")


def incomplete_requirements(t: Star, done: Iterable[str] = S.CLOSED_STATUSES) -> DataFrame:
    """Active requirements with a blank squad, program, application, priority or release."""
    owners = t["dim_squad"].select("squad_sk", F.col("application_sk").alias("_application"))
    released = t["fact_requirement_coverage"].select("issue_sk").distinct().withColumn("_released", F.lit(True))
    active = t["dim_issue"].where(~F.coalesce(F.col("status").isin(*done), F.lit(False)))
    checked = active.join(owners, "squad_sk", "left").join(released, "issue_sk", "left")
    missing = F.filter(
        F.array(
            F.when(F.col("squad_sk").isNull(), "squad"),
            F.when(F.col("program_sk").isNull(), "program"),
            F.when(F.col("_application").isNull(), "application"),
            F.when(_blank("priority"), "priority"),
            F.when(F.col("_released").isNull(), "release"),
        ),
        lambda x: x.isNotNull(),
    )
    return checked.select("issue_key", F.array_join(missing, ",").alias("missing")).where("missing <> ''")


def failures_without_defect(t: Star) -> DataFrame:
    """Failed runs with no linked defect."""
    failed = t["fact_test_run"].where((F.col("run_status") == "FAIL") & (F.coalesce("defect_count", F.lit(0)) == 0))
    return failed.select("test_run_id", "release_sk")


def requirements_without_tests(t: Star) -> DataFrame:
    """Requirements no test covers in any release."""
    tested = t["fact_requirement_coverage"].where("total_test_count > 0").select("issue_sk")
    return t["dim_issue"].join(tested, "issue_sk", "left_anti").select("issue_key", "business_area", "critical_flag")


def incomplete_closed_defects(t: Star) -> DataFrame:
    """Closed defects with a blank severity, root cause or resolution time."""
    closed = t["dim_defect"].where(F.col("status").isin(*S.CLOSED_STATUSES))
    missing = F.filter(
        F.array(
            F.when(_blank("severity"), "severity"),
            F.when(_blank("root_cause"), "root_cause"),
            F.when(F.coalesce("resolved_at", "resolution_date").isNull(), "resolution"),
        ),
        lambda x: x.isNotNull(),
    )
    return closed.select("defect_key", F.array_join(missing, ",").alias("missing")).where("missing <> ''")


def incomplete_runs(t: Star) -> DataFrame:
    """Blocked runs without reason, finished ones without time, runs without environment."""
    status = F.col("run_status")
    found = F.filter(
        F.array(
            F.when((status == "BLOCKED") & _blank("block_reason"), "block_reason"),
            F.when(status.isin("PASS", "FAIL") & (F.col("started_at").isNull() | F.col("finished_at").isNull()), "timestamp"),
            F.when(F.col("environment_sk").isNull(), "environment"),
        ),
        lambda x: x.isNotNull(),
    )
    return t["fact_test_run"].select("test_run_id", "run_status", F.explode(found).alias("missing"))


def stale_executing(t: Star, as_of: date, days: int = 1) -> DataFrame:
    """Runs still executing long after their start."""
    runs = t["fact_test_run"].where((F.col("run_status") == "EXECUTING") & (F.col("started_at") < _days_before(as_of, days)))
    return runs.select("test_run_id", "started_at")


def done_but_untested(t: Star) -> DataFrame:
    """Finished requirements whose linked tests are all still to do."""
    done = t["dim_issue"].where(F.col("status").isin(*S.CLOSED_STATUSES)).select("issue_sk", "issue_key")
    totals = t["fact_requirement_coverage"].groupBy("issue_sk").agg(
        F.sum("total_test_count").alias("tests"), F.sum("todo_test_count").alias("todo")
    )
    return done.join(totals.where("tests > 0 AND tests = todo"), "issue_sk").select("issue_key", "tests")


def resolved_but_failing(t: Star) -> DataFrame:
    """Resolved defects a linked test of which fails in its latest run.

    The links of resolved defects lead to the tests in question; only their runs are looked at.
    """
    resolved = t["dim_defect"].where(F.col("status").isin(*S.CLOSED_STATUSES)).select("defect_sk", "defect_key")
    order = ["started_at", "test_run_id", "run_status"]
    runs = t["fact_test_run"].where("test_sk IS NOT NULL").select("test_sk", *order)
    links = t["fact_defect_link"].select("defect_sk", "test_run_id").join(resolved, "defect_sk").select("defect_key", "test_run_id")
    linked = links.join(runs.select("test_run_id", "test_sk"), "test_run_id").select("defect_key", "test_sk").distinct()
    latest = windows.latest(runs.join(linked.select("test_sk").distinct(), "test_sk", "left_semi"), ["test_sk"], order)
    failing = latest.where("run_status = 'FAIL'").select("test_sk", F.col("test_run_id").alias("failing_run"))
    return linked.join(failing, "test_sk")


def squad_mismatches(t: Star, links: DataFrame) -> DataFrame:
    """Links (issue_sk, test_sk) where test and requirement belong to different squads."""
    issues = t["dim_issue"].select("issue_sk", "issue_key", F.col("squad_sk").alias("issue_squad"))
    tests = t["dim_test"].select("test_sk", "test_key", F.col("squad_sk").alias("test_squad"))
    both = links.select("issue_sk", "test_sk").distinct().join(issues, "issue_sk").join(tests, "test_sk")
    return both.where("NOT issue_squad <=> test_squad").select("issue_key", "test_key", "issue_squad", "test_squad")


def tests_without_definition(t: Star, with_steps: DataFrame | None = None) -> DataFrame:
    """Tests with neither steps, scenario nor generic definition (D15); manual ones need steps."""
    bare = t["dim_test"].where(_blank("gherkin_definition") & _blank("generic_definition"))
    if with_steps is not None:
        bare = bare.join(with_steps.select("test_key").distinct(), "test_key", "left_anti")
    return bare.select("test_key", "summary")


def type_changes(history: DataFrame, runs: DataFrame, order: str = "ord") -> DataFrame:
    """Tests whose type now differs from their first one, the change delivered after their first run.

    ``history``: (test_key, test_type_name, loaded_at, ord) of all deliveries; ``runs``: (test_key, started_at).
    """
    first = runs.groupBy("test_key").agg(F.min("started_at").alias("first_run"))
    ends = history.groupBy("test_key").agg(
        F.min_by("test_type_name", order).alias("first_type"),
        F.max_by("test_type_name", order).alias("last_type"),
        F.max("loaded_at").cast("timestamp_ntz").alias("last_load"),
    )
    changed = ends.where("first_type <> last_type").join(first, "test_key")
    return changed.where("last_load > first_run").select("test_key", "first_type", "last_type")


def type_versions(history: DataFrame) -> DataFrame:
    """``test_key, test_type_name, valid_from, valid_to``: when a test had which type, from all its deliveries
    (test_key, test_type_name, loaded_at, ord); open ends are NULL. Deliveries that change nothing start no version."""
    in_order = Window.partitionBy("test_key").orderBy("ord")
    before = F.lag("test_type_name").over(in_order)
    first = F.row_number().over(in_order) == 1
    changes = history.withColumn("_changed", first | ~before.eqNullSafe(F.col("test_type_name"))).withColumn("_first", first).where("_changed")
    start = F.when(~F.col("_first"), F.col("loaded_at"))
    return changes.select("test_key", "test_type_name", start.alias("valid_from"), F.lead("loaded_at").over(in_order).alias("valid_to"))


def runs_of_former_types(runs: DataFrame, versions: DataFrame) -> DataFrame:
    """Runs (test_key, test_run_id, started_at) whose test had another type then than it has now.

    The version a run saw is looked up by test and time; each run meets one version, and none is ordered. Runs and versions
    are dealt out by test: parsed rows are far more than Spark takes them for, and would be broadcast.
    """
    seen = versions.select("test_key", F.col("test_type_name").alias("seen_type"), "valid_from", "valid_to")
    then = F.coalesce(F.col("started_at") >= F.col("valid_from"), F.lit(True)) & F.coalesce(F.col("started_at") < F.col("valid_to"), F.lit(True))
    # only tests that have changed their type have more than one version
    changed = versions.where("valid_from IS NOT NULL").select("test_key").distinct()
    now = versions.where("valid_to IS NULL").select("test_key", F.col("test_type_name").alias("current_type"))
    of_changed = runs.where("started_at IS NOT NULL").join(dealt(changed), "test_key", "left_semi")
    found = of_changed.join(dealt(seen), "test_key").where(then).join(dealt(now), "test_key")
    return found.where("NOT seen_type <=> current_type").select("test_run_id", "test_key", "seen_type", "current_type")


def rejects(*found: DataFrame) -> DataFrame:
    """All rejected records (D16): bad JSON and unknown entity types."""
    total = found[0]
    for one in found[1:]:
        total = total.unionByName(one)
    return total


def missing_seeds(t: Star) -> DataFrame:
    """Fixed reference rows that are not in their table, or a calendar that is too short."""
    spark = t["dim_status"].sparkSession
    statuses = S.status_seed(spark).join(t["dim_status"].select("status_name"), "status_name", "left_anti")
    causes = S.root_cause_seed(spark).join(t["dim_root_cause"].select("root_cause_name"), "root_cause_name", "left_anti")
    short = t["dim_date"].agg(F.count("*").alias("n")).where("n < 365")
    rows = [
        statuses.select(F.lit("dim_status").alias("tbl"), F.col("status_name").alias("missing")),
        causes.select(F.lit("dim_root_cause").alias("tbl"), F.col("root_cause_name").alias("missing")),
        short.select(F.lit("dim_date").alias("tbl"), F.lit("calendar rows").alias("missing")),
    ]
    return rejects(*rows)


def missing_columns(t: Star) -> list[tuple[str, str]]:
    """Columns of the layout a table lacks (D17); looks at schemas only."""
    return [(name, c) for name in t if name in S.TABLES for c in S.columns(name) if c not in t[name].columns]


def summary(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, violations), one row per check."""
    counts = [df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations") for name, df in checks.items()]
    return rejects(*counts)
