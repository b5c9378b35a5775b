import json
from datetime import datetime, timezone

import sample
from pyspark.sql import functions as F

from qualitymart import schemas as S
from qualitymart.operators import quality
from qualitymart.sources import landing, staging


def pages(spark, *bodies, origin="landing/SHOP/page.json"):
    return spark.createDataFrame([(b if isinstance(b, str) else json.dumps(b), origin) for b in bodies], "body STRING, origin STRING")


def by_key(df):
    return {r["source_key"]: r for r in df.collect()}


def test_issues_are_routed_and_filtered(spark):
    found = pages(spark, {"issues": [sample.issue(), sample.defect()], "nextPageToken": "t"}, "<html>busy</html>")
    rows = by_key(landing.issues(found, "r", sample.DAY))
    assert {k: r["entity_type"] for k, r in rows.items()} == {"SHOP-10": "jira_issue", "SHOP-66": "jira_defect"}
    assert json.loads(rows["SHOP-10"]["raw_json"])["fields"]["customfield_10201"] == "Team Oak"
    since = datetime(2024, 3, 1, 16, 19, 59, tzinfo=timezone.utc)
    assert landing.issues(found, "r", sample.DAY, since=since).count() == 1
    assert landing.issues(found, "r", sample.DAY, since=since.replace(minute=20)).count() == 0
    assert landing.issues(found, "r", sample.DAY, projects=["OTHER"]).count() == 0
    assert landing.bad_pages(found).first()["reason"] == "bad_json"
    newest = landing.newest_update(landing.issues(found, "r", sample.DAY)).select(F.col("watermark_after").cast("string")).first()[0]
    assert newest == "2024-03-01 16:20:00"


def test_versions_carry_their_project(spark):
    found = pages(spark, [sample.version(), {"name": "v9", "_project_key": "old"}])
    rows = by_key(landing.versions(found, "r", sample.DAY))
    assert set(rows) == {"1", "v9"}
    assert {json.loads(r["raw_json"])["_project_key"] for r in rows.values()} == {"SHOP"}


def test_server_and_cloud_envelopes(spark):
    bare, wrapped = [{"key": "T-1"}, {"id": 7}], {"results": [{"issueId": "99"}]}
    assert set(by_key(landing.server_entities(pages(spark, bare, wrapped), "xray_test_set", "r", sample.DAY))) == {"T-1", "7", "99"}
    cloud = {"data": {"getTests": {"total": 2, "results": [{"issueId": "1", "jira": {"key": "T-1"}}, {"issueId": "2"}]}}}
    assert set(by_key(landing.cloud_entities(pages(spark, cloud), "xray_test", "r", sample.DAY))) == {"T-1", "2"}
    assert landing.cloud_entities(pages(spark, cloud), "xray_test_set", "r", sample.DAY).count() == 0


def test_runs_and_steps(spark):
    body = sample.run(steps=[{"id": "s1", "index": 1}, {"id": "s2", "index": 2}])
    runs, steps = landing.test_runs(pages(spark, [body], origin="x/SHOP-1403/p.json"), "r", sample.DAY)
    assert json.loads(by_key(runs)["5107"]["raw_json"])["_execution_key"] == "SHOP-1403"
    rows = by_key(steps)
    assert set(rows) == {"5107:s1", "5107:s2"}
    assert json.loads(rows["5107:s2"]["raw_json"])["_test_run_id"] == "5107"
    cloud = {"data": {"getTestRuns": {"results": [{"id": "5", "steps": [{"id": "a"}]}]}}}
    runs, steps = landing.test_runs(pages(spark, cloud), "r", sample.DAY, execution=F.lit("42"), cloud=True)
    assert json.loads(by_key(steps)["5:a"]["raw_json"])["_execution_issue_id"] == "42"


def test_pages_are_read_from_files(spark, tmp_path):
    (tmp_path / "SHOP").mkdir()
    (tmp_path / "SHOP" / "versions.json").write_text(json.dumps([sample.version()], indent=2))
    rows = landing.versions(landing.read_pages(spark, str(tmp_path)), "r", sample.DAY).collect()
    assert json.loads(rows[0]["raw_json"])["_project_key"] == "SHOP"


def test_staging_round_trip(spark, tmp_path):
    rows = [
        sample.record("jira_issue", "SHOP-10", sample.issue()),
        sample.record("jira_issue", "SHOP-10", sample.issue(summary="again"), 1),
        sample.record("jira_issue", "SHOP-10", sample.issue(), 2, "run-2"),
        sample.record("xray_test", "T-1", "<html>busy</html>"),
        sample.record("xray_execution", "E-1", {}),
    ]
    records = spark.createDataFrame(rows, S.STAGING)
    root = str(tmp_path / "staging")
    staging.write(records, root)
    assert staging.scan(spark, root).count() == 3
    assert staging.scan(spark, root, "xray_test").count() == 1
    late = staging.scan(spark, root, since=sample.DAY.replace(hour=1), mode="incremental").collect()
    assert [(r["source_key"], r["run_id"]) for r in late] == [("SHOP-10", "run-2")]
    again = staging.scan(spark, root, "jira_issue").where("run_id = 'run-1'").first()
    assert json.loads(again["raw_json"])["fields"]["summary"] == "again"
    assert staging.parse(staging.scan(spark, root, "xray_test")).count() == 0
    rejected = quality.rejects(staging.unknown(records), staging.bad_json(staging.known(records)))
    assert {(r["source"], r["reason"]) for r in rejected.collect()} == {("E-1", "unknown_entity"), ("T-1", "bad_json")}
