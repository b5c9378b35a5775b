"""Plans and steps on which run time, shuffles and memory depend."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from qualitymart import schemas as S
from qualitymart.operators import coverage, distinct, facts, quality, upsert
from qualitymart.plans import loads
from qualitymart.queries import builders
from qualitymart.queries import payloads as P
from qualitymart.queries.registry import Inputs
from qualitymart.functions.fieldmap import FieldMap
from qualitymart.session import together
from qualitymart.sources import landing, staging, window
from qualitymart.sources.control import Control
from qualitymart.sources.warehouse import Warehouse
from qualitymart.streaming import delta


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def tasks(df) -> int:
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_payloads_of_one_row_group_are_built_by_several_tasks(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    assert tasks(i.raw("lineitem")) == 1
    for made in (P.runs, P.tests, P.executions, P.defects, P.issues):
        assert tasks(made(i)) > 1, made
    assert P.runs(i).count() == i.raw("lineitem").count()


def test_pages_shuffle_rows_not_items(spark, sf_dir):
    pages = P.pages(Inputs(spark, sf_dir).raw("lineitem"), "concat('E-', l_orderkey)", P.RUN, "@")
    shown = physical(pages)
    # from the top down: items are collected above the only exchange
    assert shown.count("Exchange") == 1 and shown.rindex("collect_list") < shown.index("Exchange")
    assert pages.selectExpr("json_array_length(body) AS n").agg(F.sum("n")).first()[0] == Inputs(spark, sf_dir).raw("lineitem").count()


def test_a_filter_on_run_columns_does_not_cast_the_payload_again(spark, sf_dir):
    runs = facts.runs(staging.parse(P.runs(Inputs(spark, sf_dir))))
    dated = runs.where("started_at IS NOT NULL").select("test_run_id", "started_at")
    assert plan(dated).count("variant_get(v#") == 1


def test_only_the_parts_of_a_run_that_are_wanted_are_cast(spark, sf_dir):
    made = P.runs(Inputs(spark, sf_dir)).limit(300)
    parsed = staging.parse(spark.createDataFrame(made.collect(), made.schema).repartition(2))
    found = facts.runs(parsed, "test_key", "test_run_id", "started_at")
    shown = plan(found)
    assert found.columns == ["test_key", "test_run_id", "started_at"] and "StructField(startedOn," in shown
    assert not any(f"StructField({part}," in shown for part in ("status", "assignee", "defects", "fixVersions"))
    whole = facts.runs(parsed)
    assert set(facts.RUN_PARTS) == set(whole.columns)
    for columns in (("test_key", "test_run_id", "started_at"), ("test_key", "execution_key", "versions", "defects"), ("tester_id", "run_status", "root_cause_name", "duration_s")):
        assert facts.runs(parsed, *columns).exceptAll(whole.select(*columns)).isEmpty()


def test_runs_of_records_are_those_of_their_payloads(spark):
    texts = [
        '{"test":{"key":"T-1"},"startedOn":"2024-01-01","fixVersions":["v1"],"defects":["D-1"]}', '{"test":5,"startedOn":{},"fixVersions":"v","defects":null}',
        '{"id":1} {}', '{"id":1},{"id":2}', '{"id":1}] x', '', ' ', '5', 'null', '[]', '[{"id":1}]', '"x"', '{"a":1,"a":2}', '{', '{}', None,
    ]
    rows = [("r", str(n), "xray_test_run", text, datetime(2024, 3, 1)) for n, text in enumerate(texts)]
    records = spark.createDataFrame(rows, "run_id STRING, source_key STRING, entity_type STRING, raw_json STRING, loaded_at TIMESTAMP").repartition(2)
    of_records, of_payloads = facts.runs_of(records), facts.runs(staging.parse(records))
    assert of_records.schema == of_payloads.schema
    assert sorted(map(repr, of_records.collect())) == sorted(map(repr, of_payloads.collect()))
    assert of_records.count() == 10


def test_a_window_parses_each_payload_once_for_all_it_names(spark):
    records = [
        ("r1", "xray_test_run", '{"test":{"key":"T-1"},"_execution_key":"E-1","fixVersions":["v1",{"name":"v2"}],"defects":["D-1",{"key":"D-2"}]}'),
        ("r2", "xray_test_run", "{}"),
        ("r3", "xray_test_run", "not JSON"),
        ("I-1", "jira_issue", '{"fields":{"fixVersions":[{"name":"v3"}],"issuelinks":[{"outwardIssue":{"key":"T-2"}},{"inwardIssue":{}}]}}'),
        ("I-2", "jira_issue", '{"fields":{}}'),
        ("E-1", "xray_test_execution", '{"fields":{"customfield_10301":{"key":"P-1"}}}'),
        ("E-2", "xray_test_execution", "{}"),
    ]
    kept = spark.createDataFrame([("r", k, e, j, datetime(2024, 3, 1)) for k, e, j in records], "run_id STRING, source_key STRING, entity_type STRING, raw_json STRING, loaded_at TIMESTAMP")
    # one that the optimizer can't work out beforehand
    named = window._referred(kept.repartition(2), FieldMap())
    assert plan(named).count("parse_json(concat") == 3 or plan(named).count("parseJson") == 3
    assert sorted(map(tuple, named.collect())) == sorted(
        [("xray_test", "T-1"), ("xray_test", "T-2"), ("xray_test_execution", "E-1"), ("jira_defect", "D-1"), ("jira_defect", "D-2"), ("xray_test_plan", "P-1")]
        + [("jira_version", v) for v in ("v1", "v2", "v3", "UNVERSIONED")]
    )


def test_own_time_looks_only_for_keys_that_a_payload_can_have(spark):
    at = datetime(2024, 3, 1)
    texts = {
        '{"fields":{"updated":"2024-01-01T00:00:00Z"},"startedOn":"2023-01-01"}': datetime(2024, 1, 1),
        '{"fields":{"upd\\u0061ted":"2024-01-02T00:00:00Z"}}': datetime(2024, 1, 2),
        '{"updated":"no time","startedOn":null,"started_at":"2024-01-03T00:00:00+01:00"}': datetime(2024, 1, 2, 23),
        '{"star\\u0074edOn":"2024-01-04"}': datetime(2024, 1, 4),
        '{"other":{"updated":"2024-01-05"}}': at,
        "updated": at,
        None: at,
    }
    rows = spark.createDataFrame([(t, at) for t in texts], "raw_json STRING, loaded_at TIMESTAMP").repartition(1)
    found = rows.select("raw_json", window.own_time().cast("timestamp_ntz").alias("at"))
    assert {r["raw_json"]: r["at"] for r in found.collect()} == texts
    # looked up through an array, so not once for the check and once for the cast
    assert plan(found).count("get_json_object") + plan(found).count("GetJsonObject") <= 5


def test_extra_keys_are_no_variants_when_written(spark):
    pages = spark.createDataFrame([('[{"id":"a","n":null,"_execution_key":"no","steps":[{"x":"\\"\\u00e9"},{},{"_test_run_id":1},5]}]', 'landing/E"1/page.json')], "body STRING, origin STRING")
    records = landing.run_records(pages, "r", datetime(2024, 3, 1, tzinfo=timezone.utc))
    assert sorted(r["raw_json"] or "" for r in records.collect()) == sorted(
        [
            '{"id":"a","n":null,"steps":[{"x":"\\"é"},{},{"_test_run_id":1},5],"_execution_key":"E\\"1"}',
            '{"x":"\\"é","_test_run_id":"a","_execution_key":"E\\"1"}',
            '{"_test_run_id":"a","_execution_key":"E\\"1"}',
            '{"_test_run_id":"a","_execution_key":"E\\"1"}',
            "",
        ]
    )
    assert "as variant)" not in plan(records.where("entity_type = 'xray_test_step_result'").select("raw_json")).lower().replace("cast(null as variant)", "")


def test_links_into_a_filled_target_are_built_once(spark, sf_dir):
    assert "variant_get" not in plan(builders.links_into_filled_target(Inputs(spark, sf_dir)))


def test_runs_and_versions_of_tests_are_not_broadcast(spark):
    runs = spark.createDataFrame([("T-1", "r1", 1), ("T-1", "r2", 3), ("T-1", "r3", None), ("T-2", "r4", 1), (None, "r5", 1)], "test_key STRING, test_run_id STRING, d INT")
    runs = runs.select("test_key", "test_run_id", F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(d)").alias("started_at"))
    history = spark.createDataFrame([("T-1", "Manual", 0), ("T-1", "Generic", 3), ("T-2", "Manual", 0)], "test_key STRING, test_type_name STRING, d INT")
    history = history.select("test_key", "test_type_name", F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(d)").alias("loaded_at"), F.col("d").alias("ord"))
    found = quality.runs_of_former_types(runs, quality.type_versions(history))
    assert [tuple(r) for r in found.collect()] == [("r1", "T-1", "Manual", "Generic")]
    assert "Broadcast" not in physical(found)


def test_coverage_shuffles_links_not_links_times_releases(spark):
    links = spark.createDataFrame([(1, 1), (1, 2), (1, 1), (2, 2), (3, 9), (None, 1), (4, None)], "issue_sk INT, test_sk INT")
    latest = spark.createDataFrame(
        [(1, 10, "PASS", 20240101), (1, 11, "FAIL", None), (1, None, "ABORTED", 20240102), (2, 10, None, 20240103), (2, 11, "BLOCKED", 20240104), (None, 10, "PASS", 1)],
        "test_sk INT, release_sk INT, run_status STRING, date_sk INT",
    )
    planned = spark.createDataFrame([(1, 10), (3, 12)], "issue_sk INT, release_sk INT")
    found = coverage.from_latest(links, planned, latest)
    counts = [f"{s}_test_count" for s in ("total", "passing", "failing", "blocked", "executing", "todo")]
    rows = sorted((tuple(r) for r in found.select("issue_sk", "release_sk", *counts, "latest_execution_date_sk").collect()), key=repr)
    assert rows == sorted(
        [
            (1, 10, 2, 1, 0, 0, 0, 1, 20240103),
            (1, 11, 2, 0, 1, 1, 0, 0, 20240104),
            (1, None, 2, 0, 0, 0, 0, 2, 20240102),
            (2, 10, 1, 0, 0, 0, 0, 1, 20240103),
            (2, 11, 1, 0, 0, 1, 0, 0, 20240104),
            (3, 12, 1, 0, 0, 0, 0, 1, None),
            (None, 10, 0, 1, 0, 0, 0, -1, 20240101),
            (None, 11, 0, 0, 1, 0, 0, -1, None),
            (None, None, 0, 0, 0, 0, 0, 0, 20240102),
        ],
        key=repr,
    )
    # taken apart above the shuffle by requirement
    shown = plan(found)
    assert "inline(" in shown and shown.index("inline(") < shown.index("RepartitionByExpression [issue_sk")


def test_bitmaps_are_made_once_per_cell_and_block(spark):
    rows = spark.range(0, 40_000, numPartitions=4).selectExpr("id % 2 AS a", "if(id % 3 = 0, null, 'x') AS b", "if(id % 5 = 0, null, id) AS code", "id % 7 AS m")
    by, counts = ["a", "b"], {"rows": F.lit(1)}
    cells = distinct.parts(rows.union(rows), ["m", *by], {"keys": F.col("code")}, counts)
    # one aggregate above the shuffle makes them: no task makes bitmaps of its own part of a cell and block
    assert plan(cells).count("bitmap_construct_agg") == 1
    shown = physical(cells)
    assert shown.rindex("bitmap_construct_agg") < shown.index("Exchange")
    found = {(r["a"], r["b"], r["level"]): (r["keys"], r["rows"]) for r in distinct.totals(cells, by, ["keys", "rows"]).collect()}
    both = [(k % 2, None if k % 3 == 0 else "x", None if k % 5 == 0 else k) for k in range(40_000)]
    assert found[None, None, 3] == (len({c for _, _, c in both if c is not None}), 2 * len(both))
    assert found[1, None, 1] == (len({c for a, _, c in both if a == 1 and c is not None}), 2 * sum(a == 1 for a, _, _ in both))
    assert found[0, None, 0] == (len({c for a, b, c in both if a == 0 and b is None and c is not None}), 2 * sum(a == 0 and b is None for a, b, _ in both))
    assert len(found) == 4 + 2 + 2 + 1


def staged_runs(spark, n=40):
    rows = [("run-1", f"r{k}", "xray_test_run", f'{{"_execution_key":"{("E", "OLD")[k % 2]}-{k}"}}', datetime(2024, 3, 1)) for k in range(n)]
    return spark.createDataFrame(rows, S.STAGING).repartition(2)


def test_records_are_not_dealt_out_by_project_for_purges(spark, tmp_path):
    """All records of a project would meet in one task; without a purge there is no join at all."""
    control, records = Control(spark, str(tmp_path)), staged_runs(spark)
    assert "Join" not in plan(staging.without_purged(records, control.purges()))
    control.add_purge("OLD", datetime(2024, 3, 2, tzinfo=timezone.utc))
    left = staging.without_purged(records, control.purges())
    assert "BroadcastHashJoin" in physical(left) and "SortMergeJoin" not in physical(left)
    assert left.count() == 20 and left.where("raw_json LIKE '%OLD%'").isEmpty()


def test_projects_of_payloads_with_escapes_and_none(spark):
    texts = ['{"_execution_key":"A-1"}', '{"_project_key":"B","_execution_key":"A-1"}', r'{"_project_key":"C"}', '{"id":"1"}', "no JSON", None, '{"x":{"_project_key":"D"}}']
    records = spark.createDataFrame([("r", str(n), "xray_test_run", t, None) for n, t in enumerate(texts)], S.STAGING)
    found = records.select("source_key", staging.project_of(records).alias("p")).collect()
    assert [r.p for r in sorted(found)] == ["A", "B", "C", None, None, None, None]


def test_a_join_with_a_table_that_is_not_there_is_taken_out(spark, tmp_path):
    tx = Warehouse(spark, str(tmp_path)).begin()
    runs = tx.table("fact_test_run")
    merged = upsert.replace_rows(runs, runs.select("test_run_id", "release_sk"), ["test_run_id", "release_sk"])
    assert runs.isEmpty() and "Join" not in plan(merged) and runs.columns == S.columns("fact_test_run")


def test_published_files_are_the_prepared_ones(spark, tmp_path):
    """Rows are written once, whether a table is divided or not; replaced folders go, others stay."""
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=4)
    names = lambda df: {f.rsplit("/", 1)[1] for f in df.inputFiles()}
    defects = spark.createDataFrame([(k, f"D-{k}") for k in range(20)], "defect_sk BIGINT, defect_key STRING")
    statuses = spark.createDataFrame([(1, "PASS")], "status_sk BIGINT, status_name STRING")
    for rows in (defects, defects.where("defect_sk = 3")):
        tx = warehouse.begin()
        parts = tx.parts_of("dim_defect", rows)
        others = names(warehouse.rows("dim_defect").where(~F.col("bucket").isin(parts)))
        tx.put("dim_defect", rows, parts)
        tx.put("dim_status", statuses)
        prepared = {t: names(tx._rows(t, parts if t == "dim_defect" else None)) for t in ("dim_defect", "dim_status")}
        tx.publish()
        assert names(warehouse.table("dim_status")) == prepared["dim_status"]
        published = warehouse.rows("dim_defect")
        assert {r.f.rsplit("/", 1)[1] for r in published.where(F.col("bucket").isin(parts)).select(F.input_file_name().alias("f")).distinct().collect()} <= prepared["dim_defect"]
        assert {f for f in published.inputFiles() if int(f.split("bucket=")[1].split("/")[0]) not in parts} <= {f for f in published.inputFiles() if f.rsplit("/", 1)[1] in others}
    assert warehouse.table("dim_defect").where("defect_sk = 3").count() == 1 and not (tmp_path / "w" / "_prepared").joinpath(tx.folder).exists()


def test_a_batch_of_a_stream_is_read_per_entity(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(loads, "transform", lambda records, *_: seen.append((physical(records.where("entity_type = 'jira_issue'")), records.count())))
    staging.write(staged_runs(spark), str(tmp_path / "staging"))
    delta.start(spark, str(tmp_path / "staging"), str(tmp_path / "w"), str(tmp_path / "checkpoint"), date(2024, 3, 1)).awaitTermination()
    shown, n = seen[0]
    assert n == 40 and "ExistingRDD" not in shown and "PartitionFilters: [isnotnull(entity_type" in shown
    assert not list((tmp_path / "w" / "_prepared").iterdir())


def test_tasks_together_raise_what_one_raises(spark):
    assert together() == [] and together(lambda: 1, lambda: spark.range(5).count()) == [1, 5]
    with pytest.raises(ZeroDivisionError):
        together(lambda: 1, lambda: 1 // 0)


def test_runs_alone_make_no_rows_of_steps(spark):
    results = '{"id":"1","steps":[{"id":"a"},null,5]},{"key":"2","steps":[]},{"id":3},{"id":"4","steps":{}},null,7,{"id":"5","steps":null}'
    pages = spark.createDataFrame([(f'{{"results":[{results}]}}', "x/E-1/p.json"), ("[]", "x/E-2/p.json"), ("{", "x/E-3/p.json")], "body STRING, origin STRING")
    runs, steps = landing.test_runs(pages, "r", P.LOADED)
    both = landing.run_records(pages, "r", P.LOADED)
    for part, entity in ((runs, "xray_test_run"), (steps, "xray_test_step_result")):
        assert part.schema == both.schema or [f.dataType for f in part.schema] == [f.dataType for f in both.schema]
        assert sorted(map(repr, part.collect())) == sorted(map(repr, both.where(F.col("entity_type") == entity).collect()))
    assert plan(both).count("Generate") == 3 and plan(runs).count("Generate") == 2 and plan(steps).count("Generate") == 3
