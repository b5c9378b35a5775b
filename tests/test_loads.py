"""Loads end to end on a small set of payloads: golden tables, replay, streaming, control state."""

from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
import sample
from pyspark.sql import functions as F

from qualitymart import schemas as S
from qualitymart.operators import security, snapshot, upsert
from qualitymart.plans import loads, marts
from qualitymart.plans.context import Context, apply_context
from qualitymart.sources import staging
from qualitymart.sources.control import Control
from qualitymart.sources.warehouse import Update, Warehouse
from qualitymart.streaming import delta

AS_OF = date(2024, 3, 2)

# What a table means, without its surrogate keys.
MEANING = {
    "dim_release": ["release_name", "release_date", "release_date_sk", "release_train", "release_status", "is_released"],
    "dim_program": ["program_name"],
    "dim_application": ["application_name", "is_active"],
    "dim_squad": ["squad_name"],
    "dim_environment": ["environment_name"],
    "dim_tester": ["tester_id", "tester_name"],
    "dim_status": ["status_name", "status_category", "sort_order"],
    "dim_issue": ["issue_key", "summary", "priority", "critical_flag", "updated_at"],
    "dim_defect": ["defect_key", "status", "severity", "critical_flag", "root_cause"],
    "dim_test": ["test_key", "summary", "repository_path"],
    "dim_test_plan": ["test_plan_key", "status"],
    "dim_test_execution": ["execution_key", "test_plan_key", "environments_json", "revision"],
    "fact_test_step_result": ["step_result_id", "test_run_id", "step_order", "step_status", "actual_result"],
    "bridge_issue_test": ["issue_key", "test_key"],
}
RUN = "test_run_id, release_name, test_key, environment_name, status_category, root_cause_name, run_status, is_automated, duration_s, defect_count"


def meaning(t):
    got = {name: sorted((tuple(r) for r in t[name].select(*columns).collect()), key=repr) for name, columns in MEANING.items()}
    runs = marts.v6_test_run_detail(t).select(*RUN.split(", "))
    got["runs"] = sorted((tuple(r) for r in runs.collect()), key=repr)
    links = t["fact_defect_link"].join(t["dim_release"], "release_sk").select("defect_key", "test_run_id", "release_name", "open_flag")
    got["links"] = sorted(tuple(r) for r in links.collect())
    covered = marts.v3_requirement_coverage(t).select("issue_key", "release_name", "total_test_count", "passing_test_count", "todo_test_count", "coverage_status")
    got["coverage"] = sorted(tuple(r) for r in covered.collect())
    snap = marts.v8_release_snapshot(t).select("release_name", "squad_name", "total_tests", "executed_tests", "passed_tests", "total_requirements", "open_critical_defects")
    got["snapshot"] = sorted((tuple(r) for r in snap.collect()), key=repr)
    return got


def files(warehouse):
    """What is published, file by file."""
    t = warehouse.star()
    return {name: sorted(t[name].inputFiles()) for name in t}


def records(spark, *parts):
    return spark.createDataFrame([r for part in parts for r in part], S.STAGING)


@pytest.fixture(scope="module")
def replayed(spark, tmp_path_factory):
    """Three deltas applied one after the other through the job."""
    root = str(tmp_path_factory.mktemp("replay"))
    warehouse = Warehouse(spark, f"{root}/warehouse")
    loads.initialise(warehouse)
    results = []
    for n, batch in enumerate(sample.batches()):
        since = sample.DAY.replace(hour=n) - (sample.DAY - sample.DAY.replace(day=1)) if n == 0 else sample.DAY.replace(hour=n - 1)
        cfg = loads.LoadConfig(root, f"run-{n + 1}", as_of=AS_OF, since=since, advance_watermark=True)
        results.append(loads.run(spark, cfg, lambda wm, b=batch: records(spark, b)))
    return root, warehouse, results


def test_golden_tables(replayed):
    _, warehouse, results = replayed
    assert [r.status for r in results] == ["success"] * 3, [r.error_message for r in results]
    assert [r.records_extracted for r in results] == [10, 4, 4]
    got = meaning(warehouse.star())
    assert got["dim_release"] == [
        ("UNVERSIONED", None, None, None, None, False),
        ("w7.3", date(2024, 5, 1), 20240401, "wave 4", "Released", True),
        ("w7.4", None, None, None, None, False),
    ]
    assert ("ON HOLD", "Unknown", 99) in got["dim_status"] and len(got["dim_status"]) == 7
    assert got["dim_issue"] == [
        ("SHOP-10", "Changed", "P0", True, datetime(2024, 3, 1, 16, 20)),
        ("SHOP-17", "Basket survives a reload", "High", False, datetime(2024, 3, 1, 16, 20)),
    ]
    assert got["dim_defect"] == [("SHOP-66", "Closed", "Critical", True, "Application Bug")]
    assert got["dim_application"] == [("Basket", True)]
    assert got["dim_environment"] == [("SIT",), ("UAT",)]
    assert got["dim_tester"] == [("Mira Voss", "Mira Voss")]
    # The redelivered run changes its row for v1.0; the row of the version it no longer names stays.
    assert got["runs"] == [
        ("5107", "w7.3", "SHOP-703", "SIT", "Pass", "Not Applicable", "PASS", False, 330.0, 1),
        ("5107", "w7.4", "SHOP-703", "SIT", "Fail", "Not Applicable", "FAIL", False, 330.0, 2),
        ("5108", "w7.3", "SHOP-710", "SIT", "Pass", "Not Applicable", "PASS", False, 16530.0, 0),
        ("5109", "UNVERSIONED", "SHOP-703", "SIT", "Unknown", "Not Applicable", "ON HOLD", False, None, 0),
    ]
    # Links are never updated: the flag of the first delivery stays.
    assert got["links"] == [("SHOP-542", "5107", "w7.3", True), ("SHOP-542", "5107", "w7.4", True), ("SHOP-66", "5107", "w7.3", True), ("SHOP-66", "5107", "w7.4", True)]
    # A step keeps its run and order and takes the later status.
    assert got["fact_test_step_result"] == [("5107:s1", "5107", 1, "FAIL", "OK")]
    assert got["coverage"] == [
        ("SHOP-10", "UNVERSIONED", 2, 0, 2, "TODO"),
        ("SHOP-10", "w7.3", 2, 2, 0, "PASS"),
        ("SHOP-10", "w7.4", 2, 0, 1, "FAIL"),
        ("SHOP-17", "w7.3", 0, 0, 0, "NO_COVERAGE"),
    ]
    assert got["snapshot"] == [
        ("UNVERSIONED", "Team Oak", 1, 1, 0, 1, 0),
        ("w7.3", "Team Oak", 2, 2, 2, 1, 0),
        ("w7.4", "Team Oak", 1, 1, 0, 1, 0),
    ]


def test_marts_on_the_warehouse(replayed):
    t = replayed[1].star()
    health = {r["release_name"]: r for r in marts.v1_qa_health_by_release(t).collect()}
    assert health["w7.3"]["pass_rate_pct"] == Decimal("100.00") and health["w7.4"]["failed"] == 1
    quality = {r["release_name"]: r for r in marts.v9_quality_effectiveness(t).collect()}
    strict = {r["release_name"]: r for r in marts.v9_quality_effectiveness(t, strict=True).collect()}
    assert quality["w7.3"]["total_defects"] == 1 and quality["w7.3"]["requirements_without_tests"] == 1
    assert quality["w7.3"]["requirement_coverage_pct"] == Decimal("50.00")
    assert quality["UNVERSIONED"]["total_defects"] == 0 and quality["UNVERSIONED"]["defect_resolution_rate_pct"] is None
    assert (quality["w7.3"]["total_runs"], strict["w7.3"]["total_runs"]) == (2, 2)
    density = {(r["release_name"], r["severity"]): r for r in marts.v2_defect_density(t).collect()}
    assert density["w7.3", None]["total_defects"] == 1 and density["w7.3", "Critical"]["critical_defects"] == 1
    marts.register_views(t)
    assert t["dim_date"].sparkSession.sql("SELECT count(*) FROM vw_p6_test_run_detail").first()[0] == 4


def test_secured_rows_are_a_subset(spark, replayed):
    t = replayed[1].star()
    squad = t["dim_squad"].where("squad_name = 'Team Pine'").first()["squad_sk"]
    bridge = spark.createDataFrame([(squad, "b@example.com", "Squad_Member")], S.TABLES["bridge_squad_user"])
    t = t.replace(bridge_squad_user=bridge)
    assert security.secure(t, "b@example.com", "Squad_Member")["fact_test_run"].count() == 0
    assert security.secure(t, "b@example.com", "Squad_Member")["dim_issue"].count() == 1
    assert security.secure(t, "b@example.com", "Program_Manager")["fact_test_run"].count() == 0
    assert security.secure(t, "b@example.com", "CXO")["fact_test_run"].count() == 4
    assert security.secure(t, "b@example.com", None)["dim_issue"].count() == 0


def test_full_stream_equals_replayed_deltas(spark, replayed, tmp_path):
    """One streaming pass over everything staged gives the same tables as the deltas."""
    root, warehouse, _ = replayed
    other = Warehouse(spark, str(tmp_path / "warehouse"))
    loads.initialise(other)
    query = delta.start(spark, f"{root}/staging", other.root, str(tmp_path / "checkpoint"), AS_OF)
    query.awaitTermination()
    assert meaning(other.star()) == meaning(warehouse.star())
    published = files(other)
    delta.start(spark, f"{root}/staging", other.root, str(tmp_path / "checkpoint"), AS_OF).awaitTermination()
    assert files(other) == published


def test_control_state(spark, replayed):
    root, _, results = replayed
    control = Control(spark, f"{root}/control")
    assert control.get_watermark(loads.JOB) == datetime(2024, 3, 1, 16, 20, tzinfo=timezone.utc)
    log = control.run_log().collect()
    assert len(log) == 3 and {r["status"] for r in log} == {"success"}
    assert control.get_watermark("never ran") is None


def test_dry_run_and_failure_publish_nothing(spark, replayed):
    root, warehouse, _ = replayed
    control = Control(spark, f"{root}/control")
    before = (files(warehouse), control.get_watermark(loads.JOB))
    extra = [sample.record("jira_issue", "SHOP-24", sample.issue("SHOP-24"), 5, "run-4")]
    dry = loads.run(spark, loads.LoadConfig(root, "run-4", as_of=AS_OF, dry_run=True), lambda wm: records(spark, extra))
    assert dry.status == "success" and dry.records_extracted == 1 and dry.rows_processed == 0

    other = loads.LoadConfig(root, "run-6", as_of=AS_OF, dry_run=True, projects=("OTHER",))
    assert loads.run(spark, other, lambda wm: records(spark, extra)).records_extracted == 0

    def broken(_):
        raise RuntimeError("no pages")

    failed = loads.run(spark, loads.LoadConfig(root, "run-5", as_of=AS_OF), broken)
    assert failed.status == "failed" and failed.error_message == "no pages"
    assert (files(warehouse), control.get_watermark(loads.JOB)) == before
    assert staging.scan(spark, f"{root}/staging", "jira_issue").where("source_key = 'SHOP-24'").count() == 1
    assert {r["status"] for r in control.run_log().collect()} == {"success", "failed"}


def test_window_and_projects_bound_what_is_staged(spark, tmp_path):
    root = str(tmp_path)
    rows = [r for batch in sample.batches() for r in batch]
    until = datetime(2024, 3, 1, 7, 0, tzinfo=timezone.utc)
    cfg = loads.LoadConfig(root, "run-1", as_of=AS_OF, until=until)
    assert loads.run(spark, cfg, lambda wm: records(spark, rows)).status == "success"
    # the run that started at 02:45 UTC, with what it refers to, whenever that was landed
    staged = {(r["entity_type"], r["source_key"]) for r in staging.scan(spark, f"{root}/staging").collect()}
    assert ("xray_test_run", "5108") in staged and ("xray_test", "SHOP-710") in staged
    assert {e for e, _ in staged} <= {"xray_test_run", "xray_test", "xray_test_execution", "xray_test_plan", "jira_version", "xray_test_step_result"}
    facts = Warehouse(spark, f"{root}/warehouse").star()["fact_test_run"].collect()
    assert facts and all(r["test_sk"] is not None and r["execution_sk"] is not None for r in facts)
    assert Control(spark, f"{root}/control").get_watermark(loads.JOB) is None
    other = [sample.record("xray_test_run", "7", {**sample.run("7"), "_execution_key": "ELSE-1"}), sample.record("jira_version", "9", {**sample.version(), "_project_key": "ELSE"})]
    kept = loads.LoadConfig(root, "run-2", as_of=AS_OF, projects=("ELSE",), dry_run=True)
    assert loads.run(spark, kept, lambda wm: records(spark, rows, other)).records_extracted == 2


def test_watermarks_of_projects(spark, tmp_path):
    control = Control(spark, str(tmp_path))
    day = lambda n: datetime(2024, 3, n, tzinfo=timezone.utc)
    control.set_watermark("job", day(9), projects=("A",))
    assert control.get_watermark("job") is None and control.get_watermark("job", ("A",)) == day(9)
    assert control.get_watermark("job", ("A", "B")) is None
    control.set_watermark("job", day(5))
    assert control.get_watermark("job") == day(5)
    assert control.get_watermark("job", ("A",)) == day(9) and control.get_watermark("job", ("A", "B")) == day(5)
    control.set_watermark("job", day(12))
    assert control.get_watermark("job", ("A",)) == day(12)


def test_bounds_by_hand_leave_the_watermark(spark, tmp_path):
    since = datetime(2024, 1, 1, tzinfo=timezone.utc)
    assert not loads.LoadConfig("x", "r", since=since).moves_watermark and not loads.LoadConfig("x", "r", until=since).moves_watermark
    assert loads.LoadConfig("x", "r").moves_watermark and loads.LoadConfig("x", "r", since=since, advance_watermark=True).moves_watermark


RUNS = "test_run_id STRING, release_sk BIGINT, test_sk BIGINT, run_status STRING, is_automated BOOLEAN, duration_s DOUBLE, date_sk INT, month INT"


def merge_runs(spark, warehouse, rows):
    tx = warehouse.begin()
    updates = S.conform(spark.createDataFrame(rows, RUNS), "fact_test_run")
    pair = ["test_run_id", "release_sk"]
    tx.merge_months("fact_test_run", updates, pair, lambda t, u: upsert.replace_rows(t, u, pair))
    changed = {r[0] for r in loads.refresh_states(tx).collect()}
    months = tx.replaced("fact_test_run")
    tx.publish()
    return months, changed


def test_months_are_found_by_key(spark, tmp_path, monkeypatch):
    """A run that moves to another month is replaced once, and only months that hold the update's keys are read."""
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=4)
    run = lambda key, test, month, status="PASS": (key, 1, test, status, False, 60.0, month * 100 + 1, month)
    months, changed = merge_runs(spark, warehouse, [run(f"r{k}", k, 202401 + k % 6) for k in range(60)])
    assert months == [202401, 202402, 202403, 202404, 202405, 202406] and changed == set(range(60))
    before = files(warehouse)["fact_test_run"]

    read = []
    rows_of = Update._rows
    monkeypatch.setattr(Update, "_rows", lambda self, name, parts=None: read.append((name, parts)) or rows_of(self, name, parts))
    months, changed = merge_runs(spark, warehouse, [run("r3", 3, 202402, "FAIL"), run("r9", 99, 202404)])
    assert months == [202402, 202404] and changed == {3, 9, 99}
    of_facts = {name: parts for name, parts in read if name in ("fact_test_run", "state_test_runs", "state_open_links")}
    assert of_facts and all(set(parts or ()) <= {202402, 202404} for parts in of_facts.values())
    monkeypatch.undo()

    after = files(warehouse)["fact_test_run"]
    assert {f for f in before if "202402" not in f and "202404" not in f} == {f for f in after if "202402" not in f and "202404" not in f}
    t = warehouse.star()["fact_test_run"]
    assert t.count() == 60 and [(r.month, r.run_status) for r in t.where("test_run_id = 'r3'").collect()] == [(202402, "FAIL")]
    one = warehouse.begin().table("fact_test_run", [202402])
    assert "PartitionFilters: [month" in one._jdf.queryExecution().executedPlan().toString().replace("isnotnull(month", "month")
    assert {"month=202402"} == {r[0].split("/")[-2] for r in one.select(F.input_file_name()).distinct().collect()}

    # a page of two months reads those
    page = apply_context(warehouse.star(), Context(first_day=date(2024, 2, 1), last_day=date(2024, 3, 31)))["fact_test_run"]
    assert {"month=202402", "month=202403"} == {r[0].split("/")[-2] for r in page.select(F.input_file_name()).distinct().collect()}

    # the only run of a month moves away: the month has no folder any more, the state neither
    merge_runs(spark, warehouse, [("solo", 1, 1000, "PASS", False, 1.0, 202512, 202512)])
    merge_runs(spark, warehouse, [("solo", 1, 1000, "PASS", False, 1.0, 202401, 202401)])
    t = warehouse.star()
    assert not any("202512" in f for f in t["fact_test_run"].inputFiles()) and t["fact_test_run"].count() == 61
    state = warehouse.table("state_test_runs")
    full = snapshot.month_state(t["fact_test_run"]).select(*state.columns)
    assert not state.exceptAll(full).count() and not full.exceptAll(state).count()


def test_keys_without_case(spark, tmp_path):
    """Squads and tests that differ only in case are one row with one key, in the first spelling."""
    warehouse = Warehouse(spark, str(tmp_path / "w"), ci=True)
    for n, (squad, link) in enumerate((("Team Oak", "SHOP-703"), ("TEAM oak", "shop-703"))):
        rows = [sample.record("xray_test", "SHOP-703", sample.test_case(squad=squad), n, f"run-{n}"), sample.record("jira_issue", f"SHOP-{n}", sample.issue(f"SHOP-{n}", squad=squad, links=(link,)), n, f"run-{n}")]
        loads.transform(records(spark, rows), warehouse, AS_OF)
    t = Warehouse(spark, warehouse.root).star()
    assert [r.squad_name for r in t["dim_squad"].collect()] == ["Team Oak"]
    assert {r.squad_sk for r in t["dim_issue"].collect()} == {t["dim_squad"].first().squad_sk}
    assert {r.test_key for r in t["bridge_issue_test"].collect()} == {"SHOP-703"}


def test_compaction_keeps_what_a_scan_gives(spark, tmp_path):
    """Fewer files, the same records; old files stay for a running reader until they are swept."""
    root = str(tmp_path / "staging")
    for n in range(3):
        staging.write(records(spark, *sample.batches()).withColumn("loaded_at", F.expr(f"loaded_at + interval {n} minutes")).repartition(5), root)
    before = sorted(map(tuple, staging.scan(spark, root).collect()))
    many = len(spark.read.schema(staging.LAYOUT).parquet(root).inputFiles())
    running = staging.scan(spark, root)
    staging.compact(spark, root, date(2024, 3, 3))
    assert sorted(map(tuple, running.collect())) == before == sorted(map(tuple, staging.scan(spark, root).collect()))
    assert staging.sweep(spark, root, datetime(2020, 1, 1, tzinfo=timezone.utc)) == 0
    assert staging.sweep(spark, root) == many
    assert sorted(map(tuple, staging.scan(spark, root).collect())) == before
    assert len(spark.read.schema(staging.LAYOUT).parquet(root).inputFiles()) < many


def test_only_touched_buckets_of_a_dimension_are_written(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=16)
    defects = lambda keys: spark.createDataFrame([(k, "x") for k in keys], "defect_key STRING, status STRING")
    tx = warehouse.begin()
    loads._dimension(tx, "dim_defect", defects([f"D-{k}" for k in range(200)]), "defect_key", upsert.overwrite)
    tx.publish()
    before = files(warehouse)["dim_defect"]
    again = Warehouse(spark, str(tmp_path / "w"))
    assert again.buckets == 16
    tx = again.begin()
    loads._dimension(tx, "dim_defect", defects(["D-3", "D-500", "D-501"]), "defect_key", upsert.overwrite)
    assert len(tx.replaced("dim_defect")) <= 3
    tx.publish()
    rows = again.star()["dim_defect"]
    assert len(set(before) - set(files(again)["dim_defect"])) <= 3
    assert rows.count() == 202 and sorted(r[0] for r in rows.select("defect_sk").collect()) == list(range(1, 203))


def test_broken_folders_are_not_taken_for_empty(spark, tmp_path):
    (tmp_path / "control" / "pipeline_watermarks").mkdir(parents=True)
    (tmp_path / "control" / "pipeline_watermarks" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|magic"):
        Control(spark, str(tmp_path / "control")).get_watermark("job")
    assert Control(spark, str(tmp_path / "nothing")).get_watermark("job") is None


def test_purge_removes_a_project(spark, replayed):
    root, warehouse, _ = replayed
    control = Control(spark, f"{root}/control")
    loads.purge_project(warehouse, "SHOP", control)
    t = warehouse.star()
    for name in ("dim_issue", "dim_defect", "dim_test", "fact_test_run", "fact_defect_link", "fact_test_step_result", "fact_requirement_coverage"):
        assert t[name].count() == 0, name
    assert t["dim_release"].count() == 3 and t["dim_date"].where(F.col("date_sk") == 20240302).count() == 1
    left = staging.scan(spark, f"{root}/staging", purged=control.purges())
    # records that name no project stay: a version without one, a step without its execution, a reject
    assert {r["source_key"] for r in left.collect()} == {"1", "BAD", "5107:s1"}
