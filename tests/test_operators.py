"""Merge shapes, keys and window operators against small expected results."""

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from qualitymart import session
from qualitymart.functions.fieldmap import FieldMap
from qualitymart.operators import dims, keys, upsert, windows
from qualitymart.sources import landing, staging


def frame(spark, rows, schema="k STRING, a STRING, b STRING"):
    return spark.createDataFrame(rows, schema)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_merge_shapes(spark):
    target = frame(spark, [("1", "x", "y"), ("2", "x", "y")])
    updates = frame(spark, [("2", None, "new"), ("3", "n", None)])
    assert content(upsert.overwrite(target, updates, ["k"])) == [("1", "x", "y"), ("2", None, "new"), ("3", "n", None)]
    assert content(upsert.insert_absent(target, updates, ["k"])) == [("1", "x", "y"), ("2", "x", "y"), ("3", "n", None)]
    assert content(upsert.patch(target, updates, ["k"])) == [("1", "x", "y"), ("2", "x", "new"), ("3", "n", None)]
    assert content(upsert.partial(target, updates, ["k"], ["b"])) == [("1", "x", "y"), ("2", "x", "new"), ("3", "n", None)]
    assert content(upsert.replace_rows(target, updates, ["k"])) == content(upsert.overwrite(target, updates, ["k"]))
    assert upsert.changes(target, updates, ["k"]).first().asDict() == {"inserted": 1, "updated": 1}


def test_merge_with_missing_key_parts(spark):
    target = frame(spark, [("1", None, "old"), ("1", "s", "old")])
    updates = frame(spark, [("1", None, "new"), ("2", None, "new")])
    merged = upsert.overwrite(target, updates, ["k", "a"], null_safe=True)
    assert content(merged) == [("1", "s", "old"), ("1", None, "new"), ("2", None, "new")]


def test_last_known_and_first_last(spark):
    rows = spark.createDataFrame([("k", 1, "a", None), ("k", 2, None, "x"), ("k", 3, None, None)], "k STRING, ord INT, p STRING, q STRING")
    assert content(upsert.last_known(rows, ["k"], "ord")) == [("k", "a", "x")]
    assert content(upsert.first_and_last(rows, ["k"], "ord", ["p"], ["q"])) == [("k", "a", None)]


def test_merges_are_idempotent(spark):
    target, updates = frame(spark, [("1", "x", "y")]), frame(spark, [("1", "n", None), ("2", "n", "m")])
    for merge in (upsert.overwrite, upsert.insert_absent, upsert.patch):
        once = merge(target, updates, ["k"])
        assert content(merge(once, updates, ["k"])) == content(once)


def test_only_new_keys_are_numbered(spark):
    target = frame(spark, [("a", 5, "old"), ("b", 9, "old")], "name STRING, sk BIGINT, note STRING")
    updates = frame(spark, [("b", "new"), ("c", "new"), ("d", None), ("", "x"), (None, "x")], "name STRING, note STRING")
    merged = {r["name"]: (r["sk"], r["note"]) for r in keys.merge_dimension(target, updates, "name", "sk", upsert.overwrite).collect()}
    assert merged["a"] == (5, "old") and merged["b"] == (9, "new") and set(merged) == {"a", "b", "c", "d"}
    assert {merged["c"][0], merged["d"][0]} == {10, 11} and merged["c"][1] == "new"
    kept = keys.merge_dimension(target, updates, "name", "sk", upsert.insert_absent)
    assert {r["name"]: r["note"] for r in kept.collect()}["b"] == "old"


def test_ordinals_of_a_busy_day(spark):
    start = datetime(2024, 5, 1, 8)
    rows = [("k", start + timedelta(minutes=n // 5), n) for n in range(200)] + [("k", start + timedelta(days=1), 200), ("j", None, 1)]
    random.Random(3).shuffle(rows)
    runs = spark.createDataFrame(rows, "k STRING, at TIMESTAMP_NTZ, n INT")
    found = {(r["k"], r["n"]): r["run_sequence"] for r in windows.run_sequence(runs, ["k"], "at", ["n"]).collect()}
    assert all(found["k", n] == n + 1 for n in range(201)) and found["j", 1] == 1


def test_surrogate_keys_are_dense_and_stable(spark):
    target = frame(spark, [("a", 1), ("b", 2)], "name STRING, sk BIGINT")
    updates = frame(spark, [("b",), ("c",), ("d",), ("",), (None,)], "name STRING")
    merged = {r["name"]: r["sk"] for r in keys.merge_dimension(target, updates, "name", "sk", upsert.insert_absent).collect()}
    assert (merged["a"], merged["b"]) == (1, 2) and sorted(merged.values()) == [1, 2, 3, 4]
    many = spark.range(1000).select(F.col("id").cast("string").alias("name"))
    numbered = {r["name"]: r["sk"] for r in keys.number(many, "name", "sk", 10).collect()}
    assert sorted(numbered.values()) == list(range(11, 1011))
    again = {r["name"]: r["sk"] for r in keys.number(many.repartition(7), "name", "sk", 10).collect()}
    assert again == numbered


def test_latest_per_key_with_a_hot_key(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(20)}", rng.randrange(1000), n) for n in range(2000)]
    expected = {}
    for k, ts, n in rows:
        expected[k] = max(expected.get(k, (-1, -1)), (ts, n))
    df = spark.createDataFrame(rows, "k STRING, ts INT, n INT")
    assert {r["k"]: (r["ts"], r["n"]) for r in windows.latest(df, ["k"], ["ts", "n"]).collect()} == expected


def test_prior_month_is_a_calendar_month_before(spark):
    rows = [(date(2024, 1, 1), 50.0), (date(2024, 2, 1), 70.0), (date(2024, 4, 1), 60.0)]
    df = spark.createDataFrame(rows, "m DATE, v DOUBLE")
    got = {r["m"]: r["v_prior"] for r in windows.with_prior_month(df, "m", [], "v", None).collect()}
    assert got == {date(2024, 1, 1): None, date(2024, 2, 1): 50.0, date(2024, 4, 1): None}
    keyed = df.withColumn("k", F.lit(None).cast("string"))
    assert windows.with_prior_month(keyed, "m", ["k"], "v", 0.0).where("v_prior = 50").count() == 1


def test_trailing_and_month_to_date_against_brute_force(spark):
    rng = random.Random(2)
    start = date(2024, 1, 20)
    days = sorted({start + timedelta(days=rng.randrange(60)) for _ in range(25)})
    rows = [(k, d, rng.randrange(10)) for d in days for k in ("a", "b") if rng.random() < 0.8]
    df = spark.createDataFrame(rows, "k STRING, d DATE, n INT")
    got = {(r["k"], r["d"]): r["n_trailing"] for r in windows.trailing(df, "d", 7, ["k"], ["n"]).collect()}
    assert got == {(k, d): sum(x for j, e, x in rows if j == k and d - timedelta(days=6) <= e <= d) for k, d, _ in rows}
    mtd = {(r["k"], r["d"]): r["n_mtd"] for r in windows.month_to_date(df, "d", ["k"], ["n"]).collect()}
    assert mtd == {(k, d): sum(x for j, e, x in rows if j == k and e.replace(day=1) == d.replace(day=1) and e <= d) for k, d, _ in rows}


def test_run_sequence_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(None if n % 7 == 0 else f"t{n % 3}", f"2024-01-{rng.randrange(1, 6):02d} {rng.randrange(24):02d}:00:00", n) for n in range(300)]
    df = spark.createDataFrame(rows, "t STRING, s STRING, n INT").withColumn("s", F.col("s").cast("timestamp_ntz"))
    got = {r["n"]: r["run_sequence"] for r in windows.run_sequence(df, ["t"], "s", ["n"]).collect()}
    expected = {}
    for test in {t for t, _, _ in rows}:
        for place, (_, n) in enumerate(sorted((s, n) for t, s, n in rows if t == test), start=1):
            expected[n] = place
    assert got == expected


def test_many_parsed_updates_are_not_broadcast(spark, monkeypatch):
    """Rows parsed out of VARIANT are taken for a fraction of their size; by their number they are dealt out by key."""
    monkeypatch.setattr(session, "MANY", 100)
    rows = spark.range(400).selectExpr("concat('E-', id) AS source_key", """concat('{"fields":{"summary":"s', id, '"}}') AS raw_json""",
                                       "timestamp '2024-03-01 00:00:00' AS loaded_at", "'r' AS run_id")
    updates = session.cut(dims.executions(staging.parse(rows), FieldMap()).select("execution_key", "summary"))
    assert session.is_many(updates) and not session.is_many(updates.limit(100))
    target = spark.createDataFrame([(1, "E-1", "old")], "execution_sk BIGINT, execution_key STRING, summary STRING")
    merged = keys.merge_dimension(target, session.sized(updates), "execution_key", "execution_sk", upsert.overwrite, many=True)
    # only the offsets of the buckets are sent to every task
    assert merged._jdf.queryExecution().executedPlan().toString().count("+- BroadcastExchange") <= 1
    found = {r.execution_key: (r.execution_sk, r.summary) for r in merged.collect()}
    assert len(found) == 400 and found["E-1"] == (1, "s1") and {sk for sk, _ in found.values()} == set(range(1, 401))


def test_dimensions_that_grow_are_not_broadcast(spark):
    executions = dims.executions(staging.parse(spark.range(5).selectExpr("concat('E-', id) AS source_key", "'{}' AS raw_json",
                                 "timestamp '2024-03-01 00:00:00' AS loaded_at", "'r' AS run_id")), FieldMap())
    runs = spark.range(9).selectExpr("concat('E-', id) AS execution_key")
    found = keys.lookup(runs, executions, "execution_key", "execution_key", "summary", grows=True)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 9


def test_payloads_are_built_once_for_a_filter_on_projects(spark):
    pages = spark.createDataFrame([('[{"id":"1","steps":[{"id":"a"}]}]', f"x/{p}-1/p") for p in ("OLD", "NEW")], "body STRING, origin STRING")
    records = landing.run_records(pages, "r", F.lit("2024-03-01"))
    found = staging.of_projects(records, ("OLD",))
    written = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("StructsToJsonEvaluator")
    assert written(found) == written(records)
    assert found.columns == records.columns
    assert sorted(r.source_key for r in found.collect()) == ["1", "1:a"]


def test_folders_of_a_divided_table(spark, tmp_path):
    spark.range(6).selectExpr("id", "if(id < 5, id % 3, NULL) AS month").write.partitionBy("month").parquet(str(tmp_path / "t"))
    assert session.parts_in(spark, str(tmp_path / "t"), "month") == {0, 1, 2}
    assert session.parts_in(spark, str(tmp_path / "none"), "month") == set()
