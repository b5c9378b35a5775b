"""Golden cases of the scalar rules."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from qualitymart.functions import scalars as X


def evaluate(spark, values, column):
    """``column(payload)`` for each Python value given as JSON."""
    rows = [(n, json.dumps(v)) for n, v in enumerate(values)]
    df = spark.createDataFrame(rows, "n INT, s STRING").withColumn("v", F.parse_json("s"))
    return [r["r"] for r in df.select("n", column("v").alias("r")).orderBy("n").collect()]


def evaluate_text(spark, values, column):
    df = spark.createDataFrame(list(enumerate(values)), "n INT, s STRING")
    return [r["r"] for r in df.select("n", column(F.col("s")).alias("r")).orderBy("n").collect()]


def test_account(spark):
    values = [{"displayName": "Ida Lund", "accountId": "u7"}, {"accountId": "u7"}, {"displayName": "", "accountId": "u9"}, "kim", None, {}]
    assert evaluate(spark, values, X.account) == ["Ida Lund", "u7", "u9", "kim", None, None]


def test_nested_text_and_object(spark):
    values = [{"test": {"key": "T-31"}}, {"test": "x"}, {"test": None}, {}]
    assert evaluate(spark, values, lambda v: X.text(v, "$.test.key")) == ["T-31", None, None, None]
    nested = [{"a": {"b": {"size": "xl"}}}, {"a": {"b": "flat"}}, {"a": []}]
    assert evaluate(spark, nested, lambda v: F.to_json(F.when(X.is_object(X.node(v, "$.a.b")), X.node(v, "$.a.b")))) == ['{"size":"xl"}', None, None]


def test_first_component_and_select(spark):
    values = [{"components": [{"name": "Basket"}, {"name": "Prices"}]}, {"components": ["Basket"]}, {"components": []}, {}]
    assert evaluate(spark, values, X.first_component) == ["Basket", "Basket", None, None]
    assert evaluate(spark, [{"value": "Smoke"}, {"name": "Nightly"}, "plain", None], X.extract_select) == [
        "Smoke",
        "Nightly",
        "plain",
        None,
    ]


def test_truthiness(spark):
    values = [None, "", 0, 0.0, False, [], {}, "0", "false", 1, True, [0], {"a": None}]
    assert evaluate(spark, values, X.truthy) == [False] * 7 + [True] * 6


def test_custom_field(spark):
    payload = {"customFields": [{"name": "Root Cause", "value": "Stale cache"}, {"name": "severity", "value": "Low"}, {"name": "n", "value": None}]}
    cloud = {"test": {"customFields": [{"id": 1, "name": "ROOT CAUSE", "values": ["Bad seed", "x"]}]}}
    assert evaluate(spark, [payload, cloud, {}], lambda v: X.custom_field(v, "root cause")) == ["Stale cache", "Bad seed", None]
    assert evaluate(spark, [payload], lambda v: X.custom_field(v, "SEVERITY")) == ["Low"]
    assert evaluate(spark, [payload], lambda v: X.custom_field(v, "n")) == [None]


def test_envelope(spark):
    values = [{"fields": {"a": 1}, "jira": {"a": 2}}, {"jira": {"a": 2}}, {"a": 3}, {"fields": {}, "a": 4}]
    assert evaluate(spark, values, lambda v: X.text(X.envelope(v), "$.a")) == ["1", "2", "3", "4"]


def test_parse_ts(spark):
    values = ["2023-11-08T18:00:00Z", "2023-11-08T18:00:00+05:30", "2023-11-08T18:00:00.000+0000", "2023-11-08T18:00:00", None, "", "soon", "18:00"]
    noon = datetime(2023, 11, 8, 18)
    assert evaluate_text(spark, values, X.parse_ts) == [noon, datetime(2023, 11, 8, 12, 30), noon, noon, None, None, None, None]


def test_parse_date_and_key(spark):
    values = ["2023-11-08", "2023-11-08T18:00:00Z", "20231108", "later", "2023-14-01", "", None]
    day = date(2023, 11, 8)
    assert evaluate_text(spark, values, X.parse_date) == [day, day, day, None, None, None, None]
    assert evaluate_text(spark, values[:1] + [None], lambda c: X.date_to_sk(X.parse_date(c))) == [20231108, None]


def test_json_must_be_one_value(spark):
    values = ['{"a":1}', "[1,2]", '{"a":1}{', '{"a":1} {"b":2}', '{"a":1},{"b":2}', "<html>busy</html>", "", None, '{"a":1,"a":2}']
    assert evaluate_text(spark, values, lambda c: F.to_json(X.parse_json(c))) == ['{"a":1}', "[1,2]", None, None, None, None, None, None, '{"a":2}']


def test_first_environment(spark):
    values = ['["LAB","FIELD"]', '[{"name":"BENCH"}]', '[{"value":"LIVE"}]', "[]", "LAB", None]
    assert evaluate_text(spark, values, X.first_environment) == ["LAB", "BENCH", "LIVE", None, None, None]


def test_flags(spark):
    kinds = ["Manual", "MANUAL test", "Generic", None]
    assert evaluate_text(spark, kinds, X.is_automated) == [False, False, True, True]
    assert evaluate_text(spark, ["Closed", "WON'T FIX", "Open", None], X.link_open_flag) == [False, False, True, True]
    assert evaluate_text(spark, ["PASS", "TODO", "EXECUTING", None], X.is_executed) == [True, False, False, False]
    assert evaluate_text(spark, ["2023-11-08", "2023/11/08 x", "Basket", None], X.is_date_string) == [True, True, False, False]


def test_minute_boundaries_differ_from_elapsed_time(spark):
    df = spark.sql("select timestamp_ntz '2024-01-01 00:00:59' a, timestamp_ntz '2024-01-01 00:01:01' b")
    row = df.select(X.minute_boundaries_as_hours(F.col("a"), F.col("b")).alias("h"), X.duration_s(F.col("a"), F.col("b")).alias("s")).first()
    assert row["h"] == pytest.approx(1 / 60) and row["s"] == 2.0


def test_ratios_and_formats(spark):
    df = spark.sql("select 23 p, 4000 t, 0 z")
    row = df.select(
        X.pct(F.col("p"), F.col("t")).alias("pct"),
        X.pct(F.col("p"), F.col("z")).alias("none"),
        X.divide(F.col("p"), F.col("z")).alias("alt"),
        X.format_change(F.lit(-1.25)).alias("down"),
        X.format_change(F.lit(2.0)).alias("up"),
        X.format_change(F.lit(None).cast("double")).alias("blank"),
        X.format_change_arrow(F.lit(-1.25)).alias("arrow"),
        X.coverage_label(F.lit("FAIL")).alias("label"),
        X.coverage_label(F.lit("?")).alias("other"),
    ).first()
    assert str(row["pct"]) == "0.58" and row["none"] is None and row["alt"] == 0.0
    assert (row["down"], row["up"], row["blank"], row["arrow"]) == ("-1.3%", "+2.0%", "-", "▼ 1.3%")
    assert (row["label"], row["other"]) == ("✗ Failing", "— Not Covered")
