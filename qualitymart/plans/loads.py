"""Loads: staged records to published tables, in full or as a delta.

The order is dimensions before facts: versions, issues, defects, tests, plans, executions, runs with
their links, steps, coverage, snapshot. Everything a load changes is prepared first and published at its end.

A load reads what it changes: the buckets of its keys in dimensions and locators, the months of its runs in facts.
Coverage and snapshot are kept up from a state per month (``snapshot.month_state``): the months that the load rewrote are
counted anew, the tests whose state differs lead to the requirements whose coverage is made again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from qualitymart import schemas as S
from qualitymart.functions import calendar
from qualitymart.functions import scalars as X
from qualitymart.functions.fieldmap import FieldMap
from qualitymart.operators import coverage, dims, facts, keys, snapshot, upsert, windows
from qualitymart.session import configure, cut, dealt, is_many, no_rows, sized, stored, together
from qualitymart.sources import staging, window
from qualitymart.sources.control import Control
from qualitymart.sources.warehouse import HASHED, Update, Warehouse

JOB = "delta_extractor"

# A batch without any of these cannot change requirement coverage.
COVERAGE_INPUTS = {"jira_version", "jira_issue", "xray_test", "xray_test_run"}


def initialise(
    warehouse: Warehouse, start: date = calendar.DEFAULT_START, end: date = calendar.DEFAULT_END
) -> None:
    """Seed statuses, root causes and the calendar; known rows stay, calendar names are corrected."""
    spark = warehouse.spark
    tx = warehouse.begin()
    _insert_new(tx, "dim_status", S.status_seed(spark), "status_name")
    _insert_new(tx, "dim_root_cause", S.root_cause_seed(spark), "root_cause_name")
    tx.put("dim_date", calendar.refresh_names(tx.table("dim_date"), calendar.dim_date(spark, start, end)))
    tx.publish()


def _dimension(tx: Update, name: str, updates: DataFrame, key: str, merge) -> None:
    """Merge into a dimension; of one kept in buckets, only those of the updates' keys are read and written."""
    sk = S.columns(name)[0]
    updates = updates.where(F.col(key).isNotNull() & (F.col(key) != ""))
    parts = highest = None
    many = False
    if name in HASHED:
        updates = cut(updates)
        many = is_many(updates)
        updates = dealt(updates, many)
        parts = tx.parts_of(name, updates)
        highest = tx.table(name).agg(F.coalesce(F.max(sk), F.lit(0)).alias("m")).first()["m"]
    target = tx.table(name, parts)
    merged = keys.merge_dimension(target, updates, key, sk, merge, highest, many)
    if "is_active" in merged.columns:
        merged = merged.fillna(True, subset=["is_active"])
    if "is_released" in merged.columns:
        merged = merged.fillna(False, subset=["is_released"])
    if name == "dim_status":
        merged = merged.fillna(99, subset=["sort_order"])
    together(lambda: tx.count_changes(name, target, updates, [key], merge), lambda: tx.put(name, merged, parts))


def _insert_new(tx: Update, name: str, updates: DataFrame, key: str) -> None:
    """Insert-if-absent that leaves the table alone when it already has every key."""
    named = updates.where(F.col(key).isNotNull() & (F.col(key) != ""))
    if not upsert.absent(named, tx.table(name), [key]).isEmpty():
        _dimension(tx, name, named, key, upsert.insert_absent)


def _names(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(column).where(F.col(column).isNotNull() & (F.col(column) != "")).distinct()


def _latest(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """Last delivery per key, without the order column."""
    chosen = rows.select(key, *columns, "ord") if columns else rows
    return windows.latest(chosen.where(F.col(key).isNotNull() & (F.col(key) != "")), [key], ["ord"]).drop("ord")


def _spelled(tx: Update, rows: DataFrame, **dimensions: str) -> DataFrame:
    """Natural keys (column=dimension) in the spelling of their dimension, if the warehouse doesn't mind case."""
    if tx.warehouse.ci:
        for column, dimension in dimensions.items():
            rows = keys.respelled(rows, column, F.col("ord"), tx.table(dimension), S.columns(dimension)[1])
    return rows


def load_versions(tx: Update, parsed: DataFrame) -> None:
    rows = _spelled(tx, dims.releases(parsed), release_name="dim_release")
    order = "ord"
    known = upsert.last_known(rows.drop("release_date_sk"), ["release_name"], order)
    flags = rows.groupBy("release_name").agg(
        F.bool_or(F.col("release_status") == "Released").alias("is_released"),
        F.min_by("release_date_sk", F.when(F.col("release_date_sk").isNotNull(), F.col(order))).alias("release_date_sk"),
    )
    rules = {
        "is_released": F.coalesce(F.col("t.is_released"), F.lit(False)) | F.col("u.is_released"),
        # Once set, the key of the release day stays, even if the day moves.
        "release_date_sk": F.coalesce(F.col("t.release_date_sk"), F.col("u.release_date_sk")),
    }
    merge = lambda target, updates, on: upsert.patch(target, updates, on, rules)
    _dimension(tx, "dim_release", known.join(flags, "release_name"), "release_name", merge)


def ensure_releases(tx: Update, rows: DataFrame) -> None:
    """Releases named by runs come into being without further attributes."""
    _insert_new(tx, "dim_release", _names(rows, "release_name"), "release_name")


def load_issues(tx: Update, parsed: DataFrame, fields_map: FieldMap) -> DataFrame:
    """Returns the keys of the delivered issues."""
    names = {"program_name": "dim_program", "application_name": "dim_application", "squad_name": "dim_squad", "issue_key": "dim_issue"}
    rows = cut(_spelled(tx, dims.issues(parsed, fields_map), **names))
    _insert_new(tx, "dim_program", _names(rows, "program_name"), "program_name")
    programs = tx.table("dim_program")
    applications = _latest(rows, "application_name", "platform", "program_name")
    applications = keys.lookup(applications, programs, "program_name", "program_name", "program_sk").drop("program_name")
    _dimension(tx, "dim_application", applications, "application_name", upsert.overwrite)
    squads = _latest(rows, "squad_name", "program_name", "application_name")
    squads = keys.lookup(squads, programs.withColumnRenamed("program_name", "_program"), "program_name", "_program", "program_sk")
    squads = keys.lookup(
        squads, tx.table("dim_application").withColumnRenamed("application_name", "_app"), "application_name", "_app", "application_sk"
    ).drop("program_name", "application_name")
    _dimension(tx, "dim_squad", squads, "squad_name", upsert.overwrite)
    latest = cut(_latest(rows, "issue_key"))
    delivered_keys = dealt(latest.select("issue_key"), is_many(latest))
    issues = keys.lookup(latest, programs.withColumnRenamed("program_name", "_program"), "program_name", "_program", "program_sk")
    issues = keys.lookup(issues, tx.table("dim_squad").select("squad_name", "squad_sk").withColumnRenamed("squad_name", "_squad"), "squad_name", "_squad", "squad_sk")
    wanted = [c for c in S.columns("dim_issue") if c != "issue_sk"]
    together(
        lambda: _dimension(tx, "dim_issue", issues.select(*wanted), "issue_key", upsert.overwrite),
        lambda: _replace_bridge(tx, "bridge_issue_test", latest, delivered_keys, F.col("linked_keys"), "test_key"),
        lambda: _replace_bridge(tx, "bridge_issue_release", latest, delivered_keys, F.col("fix_versions"), "release_name"),
    )
    return delivered_keys


def _replace_bridge(tx: Update, name: str, issues: DataFrame, delivered: DataFrame, values, column: str) -> None:
    """The links of the delivered issues replace their former ones."""
    pairs = issues.select("issue_key", F.explode(F.array_distinct(values)).alias(column)).where(F.col(column).isNotNull())
    if tx.warehouse.ci:
        dimension = "dim_test" if column == "test_key" else "dim_release"
        pairs = keys.respelled(pairs, column, F.col(column), tx.table(dimension), column).distinct()
    parts = tx.parts_of(name, issues)
    kept = tx.table(name, parts).join(delivered, "issue_key", "left_anti")
    tx.put(name, kept.unionByName(pairs), parts)


def _with_owner(tx: Update, rows: DataFrame) -> DataFrame:
    """Squad key by name; squads are looked up here, never created."""
    squads = tx.table("dim_squad").select(F.col("squad_name").alias("_squad"), "squad_sk")
    return keys.lookup(rows, squads, "squad_name", "_squad", "squad_sk")


def load_defects(tx: Update, parsed: DataFrame, fields_map: FieldMap) -> None:
    names = {"defect_key": "dim_defect", "squad_name": "dim_squad", "application_name": "dim_application"}
    rows = _with_owner(tx, _latest(_spelled(tx, dims.defects(parsed, fields_map), **names), "defect_key"))
    applications = tx.table("dim_application").select(F.col("application_name").alias("_app"), "application_sk")
    rows = keys.lookup(rows, applications, "application_name", "_app", "application_sk")
    wanted = [c for c in S.columns("dim_defect") if c not in ("defect_sk", "resolution_date")]
    _dimension(tx, "dim_defect", rows.select(*wanted), "defect_key", upsert.overwrite)


def load_tests(tx: Update, parsed: DataFrame, fields_map: FieldMap) -> DataFrame:
    """Returns the keys of the delivered tests."""
    rows = cut(_spelled(tx, dims.tests(parsed, fields_map), test_key="dim_test", squad_name="dim_squad", test_type_name="dim_test_type"))
    _insert_new(tx, "dim_test_type", _names(rows, "test_type_name"), "test_type_name")
    types = tx.table("dim_test_type").withColumnRenamed("test_type_name", "_type")
    tests = keys.lookup(_with_owner(tx, _latest(rows, "test_key")), types, "test_type_name", "_type", "test_type_sk")
    wanted = [c for c in S.columns("dim_test") if c != "test_sk"]
    _dimension(tx, "dim_test", tests.select(*wanted), "test_key", upsert.overwrite)
    return _names(rows, "test_key")


def load_plans(tx: Update, parsed: DataFrame, fields_map: FieldMap) -> None:
    rows = _spelled(tx, dims.plans(parsed, fields_map), test_plan_key="dim_test_plan", squad_name="dim_squad")
    rows = _with_owner(tx, _latest(rows, "test_plan_key"))
    wanted = [c for c in S.columns("dim_test_plan") if c != "test_plan_sk"]
    _dimension(tx, "dim_test_plan", rows.select(*wanted), "test_plan_key", upsert.overwrite)


def load_executions(tx: Update, parsed: DataFrame, fields_map: FieldMap) -> None:
    rows = cut(_spelled(tx, dims.executions(parsed, fields_map), execution_key="dim_test_execution"))
    _insert_new(tx, "dim_environment", dims.environments(rows), "environment_name")
    _dimension(tx, "dim_test_execution", _latest(rows, "execution_key"), "execution_key", upsert.overwrite)


def run_rows(tx: Update, records: DataFrame) -> DataFrame:
    """Runs of staged records, stored as columns, since each of the passes of ``load_runs`` reads some."""
    names = {"test_key": "dim_test", "execution_key": "dim_test_execution", "tester_id": "dim_tester", "run_status": "dim_status"}
    return stored(_spelled(tx, facts.runs_of(records), **names, root_cause_name="dim_root_cause"))


def load_runs(tx: Update, rows: DataFrame, refresh_open_flag: bool = False) -> None:
    testers = upsert.last_known(facts.testers(rows), ["tester_id"], "ord")
    seen = _names(rows, "run_status").withColumnRenamed("run_status", "status_name")
    together(
        lambda: _dimension(tx, "dim_tester", testers, "tester_id", upsert.patch),
        lambda: _insert_new(tx, "dim_status", seen.withColumn("status_category", F.lit("Unknown")), "status_name"),
        lambda: ensure_releases(tx, rows.select(F.explode("versions").alias("release_name"))),
    )
    together(lambda: _load_run_facts(tx, rows), lambda: _load_links(tx, rows, refresh_open_flag))


def _load_run_facts(tx: Update, rows: DataFrame) -> None:
    # Redeliveries with the same versions are dropped before the lookups, the rest after the fan-out. One load has none.
    first, last = rows.agg(F.min("ord.run_id"), F.max("ord.run_id")).first()
    once = rows.drop("defects")
    if first != last:
        once = windows.latest(once, ["test_run_id", "versions"], ["ord"])
    pair = ["test_run_id", "release_sk"]
    fanned = facts.test_run_facts(once, tx.star())
    wanted = [c for c in S.columns("fact_test_run") if c in fanned.columns]
    runs = sized(cut(windows.latest(fanned.select(*wanted, "ord"), pair, ["ord"]).drop("ord")))
    tx.merge_months("fact_test_run", runs, pair, lambda t, u: upsert.replace_rows(t, u, pair))


def _load_links(tx: Update, rows: DataFrame, refresh_open_flag: bool) -> None:
    triple = ["defect_key", "test_run_id", "release_sk"]
    linked = facts.defect_links(rows, tx.star())
    pick = windows.latest if refresh_open_flag else windows.earliest
    links = sized(cut(pick(linked, triple, ["ord"]).drop("ord")))
    keep = upsert.replace_rows if refresh_open_flag else upsert.insert_absent
    tx.merge_months("fact_defect_link", links, triple, lambda t, u: keep(t, u, triple))


#: What a later delivery changes of a step.
MOVING = ["step_status", "actual_result", "comment"]


def step_rows(parsed: DataFrame) -> DataFrame:
    return sized(cut(upsert.first_and_last(facts.steps(parsed), ["step_result_id"], "ord", ["test_run_id", "step_order"], MOVING)))


def load_steps(tx: Update, steps: DataFrame) -> None:
    # Steps are filed under the month of their run.
    filed = tx.months_of("fact_test_run", steps.select("test_run_id").distinct()).groupBy("test_run_id").agg(F.max("month").alias("month"))
    steps = sized(cut(steps.join(filed, "test_run_id", "left").fillna(0, subset=["month"])))
    tx.merge_months(
        "fact_test_step_result", steps, ["step_result_id"], lambda t, u: upsert.partial(t, u, ["step_result_id"], MOVING)
    )


def refresh_states(tx: Update) -> DataFrame:
    """Count the months anew that the update has rewritten; ``test_sk`` of the tests whose state differs from before."""
    months, of_links = tx.replaced("fact_test_run"), tx.replaced("fact_defect_link")
    before = tx.table("state_test_runs", months)
    together(
        lambda: of_links and tx.put("state_open_links", snapshot.open_link_state(tx.table("fact_defect_link", of_links)), of_links),
        lambda: months and tx.put("state_test_runs", snapshot.month_state(tx.table("fact_test_run", months)), months),
    )
    after = tx.table("state_test_runs", months)
    # rows that occur more often on one side than on the other, from one pass over both
    sides = before.withColumn("_n", F.lit(-1)).unionByName(after.withColumn("_n", F.lit(1)))
    differing = sides.groupBy(*before.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return sized(cut(differing.select("test_sk").distinct()))


def load_coverage(tx: Update, issue_keys: DataFrame, test_keys: DataFrame, changed_tests: DataFrame) -> None:
    """Make the coverage of the requirements anew that an update may change.

    These are the given issues (``issue_key``), those linked to the given tests (``test_key``) or to tests whose state
    changed (``test_sk``), and those planned for releases that the update has added.
    """
    tests = tx.table("dim_test").select("test_sk", "test_key")
    keys_of_tests = test_keys.select("test_key").union(changed_tests.join(tests, "test_sk").select("test_key")).distinct()
    new = tx.table("dim_release").select("release_name").join(tx.warehouse.table("dim_release").select("release_name"), "release_name", "left_anti")
    linked = tx.table("bridge_issue_test").join(keys_of_tests, "test_key", "left_semi").select("issue_key")
    promised = tx.table("bridge_issue_release").join(new, "release_name", "left_semi").select("issue_key")
    affected = issue_keys.select("issue_key").union(linked).union(promised).distinct()
    issues = sized(cut(tx.table("dim_issue").select("issue_sk", "issue_key").join(affected, "issue_key", "left_semi")))
    parts = tx.parts_of("fact_requirement_coverage", issues)

    links = sized(cut(tx.table("bridge_issue_test").join(issues, "issue_key").join(tests, "test_key")))
    releases = tx.table("dim_release").select("release_sk", "release_name")
    planned = tx.table("bridge_issue_release").join(issues, "issue_key").join(releases, "release_name")
    state = tx.table("state_test_runs").join(links.select("test_sk").distinct(), "test_sk", "left_semi")
    covered = coverage.from_latest(links, planned, snapshot.latest_of_state(state))
    others = tx.table("fact_requirement_coverage", parts).join(issues.select("issue_sk"), "issue_sk", "left_anti")
    tx.put("fact_requirement_coverage", others.unionByName(S.conform(covered, "fact_requirement_coverage")), parts)


def load_snapshot(tx: Update, as_of: date) -> None:
    """Snapshot of the day from the monthly states, merged with one taken earlier that day."""
    on = ["snapshot_date_sk", "release_sk", "squad_sk"]
    t = tx.star()
    runs = snapshot.rollup_of_state(tx.table("state_test_runs"), t["dim_test"])
    open_critical = snapshot.open_critical_of_state(tx.table("state_open_links"), t["dim_defect"])
    rows = cut(snapshot.of_day(t, as_of, runs, open_critical))
    days = tx.parts_of("fact_cycle_snapshot", rows)
    if days:
        held = tx.table("fact_cycle_snapshot", days)
        together(
            lambda: tx.count_changes("fact_cycle_snapshot", held, rows, on),
            lambda: tx.put("fact_cycle_snapshot", upsert.overwrite(held, rows, on, null_safe=True), days),
        )


def transform(
    records: DataFrame,
    warehouse: Warehouse,
    as_of: date,
    fields_map: FieldMap | None = None,
    refresh_open_flag: bool = False,
    changed: dict[str, tuple[int, int]] | None = None,
) -> dict[str, int]:
    """Apply staged records to the published tables; rows processed per entity type.

    Nothing is published unless every step succeeds. ``changed`` gets the rows inserted and updated per table.
    """
    configure(warehouse.spark)
    fields_map = fields_map or FieldMap()
    counts = {r["entity_type"]: r["count"] for r in records.groupBy("entity_type").count().collect()}
    tx = warehouse.begin()
    of = lambda entity: records.where(F.col("entity_type") == entity)
    parsed = lambda entity: staging.parse(of(entity))
    plan: dict[str, Callable[[], DataFrame | None]] = {
        "jira_version": lambda: load_versions(tx, parsed("jira_version")),
        "jira_issue": lambda: load_issues(tx, parsed("jira_issue"), fields_map),
        "jira_defect": lambda: load_defects(tx, parsed("jira_defect"), fields_map),
        "xray_test": lambda: load_tests(tx, parsed("xray_test"), fields_map),
        "xray_test_plan": lambda: load_plans(tx, parsed("xray_test_plan"), fields_map),
        "xray_test_execution": lambda: load_executions(tx, parsed("xray_test_execution"), fields_map),
        "xray_test_run": lambda: run_rows(tx, of("xray_test_run")),
        "xray_test_step_result": lambda: step_rows(parsed("xray_test_step_result")),
    }
    # Defects, tests and plans look squads up, which issues bring. Runs and steps are parsed beside them and merged after
    # them. Where case doesn't matter, each takes the spelling of those before it.
    owners, owned = ("jira_version", "jira_issue"), ("jira_defect", "xray_test", "xray_test_plan")
    apart = ("xray_test_execution", "xray_test_run", "xray_test_step_result")
    delivered: dict[str, DataFrame | None] = {}

    def load(*entities: str) -> None:
        for entity in entities:
            if counts.get(entity):
                delivered[entity] = plan[entity]()

    def each(entities: tuple[str, ...]) -> list[Callable[[], None]]:
        return [lambda e=entity: load(e) for entity in entities]

    if warehouse.ci:
        load(*plan)
    else:
        together(lambda: (load(*owners), together(*each(owned))), *each(apart))
    if "xray_test_run" in delivered:
        load_runs(tx, delivered["xray_test_run"], refresh_open_flag)
    if "xray_test_step_result" in delivered:
        load_steps(tx, delivered["xray_test_step_result"])
    changed_tests = refresh_states(tx)
    if COVERAGE_INPUTS & counts.keys():
        none = no_rows(warehouse.spark, "issue_key STRING, test_key STRING")
        load_coverage(tx, delivered.get("jira_issue", none), delivered.get("xray_test", none), changed_tests)
    load_snapshot(tx, as_of)
    tx.publish()
    if changed is not None:
        changed |= tx.changed
    return counts


def purge_project(warehouse: Warehouse, project: str, control: Control | None = None) -> None:
    """Remove a project's rows (U7): links, runs and steps first, then the dimensions, then coverage.

    Runs go with their test or their execution; only months that hold some of them are rewritten, and only buckets
    that hold the project's keys. With ``control`` what is staged of the project becomes void as well, so that a full
    refresh doesn't bring it back. The project's figures leave the snapshots of its squads with the next load, which
    takes that day's anew.
    """
    tx = warehouse.begin()
    t = tx.star()
    of_project = lambda name, key: t[name].where(F.substring_index(key, "-", 1) == project)
    gone_tests = sized(cut(of_project("dim_test", "test_key").select("test_sk", "test_key")))
    gone_executions = sized(cut(of_project("dim_test_execution", "execution_key").select("execution_sk")))
    runs = t["fact_test_run"].select("test_run_id", "test_sk", "execution_sk")
    of_tests = runs.join(gone_tests.select("test_sk"), "test_sk", "left_semi").select("test_run_id")
    of_executions = runs.join(gone_executions, "execution_sk", "left_semi").select("test_run_id")
    gone_runs = sized(cut(of_tests.union(of_executions).distinct()))
    gone_defects = sized(cut(of_project("fact_defect_link", "defect_key").select("defect_key").distinct()))
    facts_without = [lambda f=fact: tx.remove_rows(f, gone_runs, "test_run_id") for fact in ("fact_test_step_result", "fact_test_run")]
    together(*facts_without, lambda: (tx.remove_rows("fact_defect_link", gone_runs, "test_run_id"), tx.remove_rows("fact_defect_link", gone_defects, "defect_key")))
    # requirements that lose a linked test are covered anew; those of the project go
    issues = of_project("dim_issue", "issue_key").select("issue_key", "issue_sk")
    gone_issues = sized(cut(issues))
    left = t["bridge_issue_test"].join(gone_tests.select("test_key"), "test_key", "left_semi").select("issue_key").distinct()
    left = sized(cut(left.join(gone_issues.select("issue_key"), "issue_key", "left_anti")))

    def purge(name: str) -> None:
        key = HASHED.get(name, "test_plan_key")
        parts = tx.parts_of(name, of_project(name, key)) if name in HASHED else None
        tx.put(name, upsert.purge_project(tx.table(name, parts), key, project), parts)

    named = ("bridge_issue_test", "bridge_issue_release", "dim_issue", "dim_defect", "dim_test", "dim_test_plan", "dim_test_execution")
    together(*[lambda n=name: purge(n) for name in named])
    parts = tx.parts_of("fact_requirement_coverage", gone_issues)
    tx.put("fact_requirement_coverage", tx.table("fact_requirement_coverage", parts).join(gone_issues.select("issue_sk"), "issue_sk", "left_anti"), parts)
    load_coverage(tx, left, no_rows(warehouse.spark, "test_key STRING"), refresh_states(tx))
    tx.publish()
    if control is not None:
        control.add_purge(project)


@dataclass(frozen=True)
class LoadConfig:
    """Settings of one load. ``since`` overrides the stored watermark; ``until`` bounds a backfill.

    The watermark moves unless the bounds are given by hand; ``advance_watermark`` decides otherwise. With ``ci`` natural
    keys that differ only in case are the same, and keep their first spelling; names of versions in runs compare exactly.
    """

    root: str
    run_id: str
    mode: str = "incremental"
    job: str = JOB
    as_of: date | None = None
    since: datetime | None = None
    until: datetime | None = None
    projects: tuple[str, ...] = ()
    dry_run: bool = False
    advance_watermark: bool | None = None
    fields_map: FieldMap = field(default_factory=FieldMap)
    ci: bool = False

    @property
    def moves_watermark(self) -> bool:
        return self.since is None and self.until is None if self.advance_watermark is None else self.advance_watermark

    @property
    def staging(self) -> str:
        return f"{self.root}/staging"


@dataclass(frozen=True)
class LoadResult:
    status: str
    records_extracted: int = 0
    rows_processed: int = 0
    watermark_before: datetime | None = None
    watermark_after: datetime | None = None
    error_message: str | None = None
    rows_upserted: int = 0


def run(spark: SparkSession, cfg: LoadConfig, extract: Callable[[datetime | None], DataFrame]) -> LoadResult:
    """One load: extract since the watermark, stage, transform, advance the watermark.

    ``extract`` gives the staging records to load. The watermark moves to the newest update seen (else
    to the start of the load), only after full success, never in a dry run or a bounded backfill. A load of some projects
    reads from and moves the marks of those projects alone, so that a later load of all misses nothing. A bounded backfill
    takes what changed in its window with all that it refers to.
    """
    configure(spark)
    control = Control(spark, f"{cfg.root}/control")
    started = datetime.now(tz=timezone.utc)
    before = cfg.since
    if before is None and cfg.mode == "incremental":
        before = control.get_watermark(cfg.job, cfg.projects)
    entry = control.start_run(cfg.job, watermark_before=before, now=started)
    try:
        records = extract(before)
        if cfg.projects:
            records = staging.of_projects(records, cfg.projects)
        stamp = X.parse_ts(F.get_json_object("raw_json", "$.fields.updated")).cast("timestamp")
        is_issue = F.col("entity_type").isin("jira_issue", "jira_defect")
        if cfg.until is not None:
            records = window.closed(staging.known(records), cfg.since, cfg.until, cfg.fields_map)
        seen = Observation()
        staging.write(
            records.observe(
                seen, F.count(F.lit(1)).alias("n"), F.max(F.when(is_issue, F.unix_micros(stamp))).alias("newest")
            ),
            cfg.staging,
        )
        extracted, newest = seen.get["n"], seen.get["newest"]
        after = datetime.fromtimestamp(newest / 1e6, tz=timezone.utc) if newest is not None else None
        processed = upserted = 0
        if not cfg.dry_run:
            todo = staging.scan(spark, cfg.staging, since=before, mode=cfg.mode, purged=control.purges())
            warehouse = Warehouse(spark, f"{cfg.root}/warehouse", ci=cfg.ci)
            changed: dict[str, tuple[int, int]] = {}
            counts = transform(todo, warehouse, cfg.as_of or started.date(), cfg.fields_map, changed=changed)
            processed = sum(counts.values())
            upserted = sum(inserted + updated for inserted, updated in changed.values())
            after = after or started
            if cfg.moves_watermark:
                control.set_watermark(cfg.job, after, projects=cfg.projects)
        control.finish_run(
            entry, "success", records_extracted=extracted, rows_processed=processed, rows_upserted=upserted, watermark_after=after
        )
        return LoadResult("success", extracted, processed, before, after, rows_upserted=upserted)
    except Exception as error:  # noqa: BLE001 - the run log must record any failure
        control.finish_run(entry, "failed", error_message=str(error))
        return LoadResult("failed", watermark_before=before, error_message=str(error))
