import json
from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from qualitymart.functions import calendar
from qualitymart.functions.fieldmap import FieldMap, FieldMapping


def extract(spark, payload, kind, field="customfield_1"):
    fields = FieldMap([FieldMapping(field, "x", "t", "c", "jira_issue", kind)])
    df = spark.createDataFrame([(json.dumps(payload),)], "s STRING").withColumn("v", F.parse_json("s"))
    return df.select(*fields.columns("jira_issue", F.col("v"))).first()["x"]


@pytest.mark.parametrize(
    "kind, value, expected",
    [
        ("string", "Storefront", "Storefront"),
        ("string", "", None),
        ("string", 5, "5"),
        ("select_value", {"value": "Smoke", "id": "8"}, "Smoke"),
        ("select_value", "Smoke", "Smoke"),
        ("issue_key", {"key": "SHOP-6"}, "SHOP-6"),
        ("issue_key", "SHOP-6", "SHOP-6"),
        ("unknown", "x", "x"),
        ("string", None, None),
    ],
)
def test_text_coercions(spark, kind, value, expected):
    assert extract(spark, {"customfield_1": value}, kind) == expected


def test_json_coercions(spark):
    environments = [{"value": "Lab"}, {"value": "Field"}]
    assert json.loads(extract(spark, {"customfield_1": environments}, "array")) == ["Lab", "Field"]
    assert json.loads(extract(spark, {"customfield_1": "Lab"}, "array")) == ["Lab"]
    steps = [{"index": 4, "step": "Weigh it"}]
    assert json.loads(extract(spark, {"customfield_1": steps}, "json")) == steps
    assert extract(spark, {}, "array") is None


def test_map_file(spark, tmp_path):
    path = tmp_path / "map.json"
    mapping = FieldMapping("customfield_9", "squad_name", "dim_squad", "squad_name", "xray_test", "string")
    path.write_text(json.dumps({"mappings": [mapping._asdict(), {**mapping._asdict(), "field_type": "odd"}]}, indent=1))
    loaded = FieldMap.load(spark, str(path))
    assert loaded.mappings_for("xray_test")[0] == mapping and loaded.mappings_for("jira_issue") == []
    assert loaded.unknown_types(spark).count() == 1
    with pytest.raises(AnalysisException):
        FieldMap.load(spark, str(tmp_path / "missing.json"))


def test_default_map_has_fourteen_rows():
    assert len(FieldMap().mappings) == 14


def test_calendar(spark):
    rows = {r["date_sk"]: r for r in calendar.dim_date(spark, date(2024, 1, 1), date(2024, 12, 31)).collect()}
    assert len(rows) == 366
    sunday = rows[20241006]
    assert (sunday["quarter"], sunday["month_name"], sunday["day_name"]) == (4, "October", "Sunday")
    assert (sunday["day_of_week"], sunday["is_weekend"], sunday["fiscal_quarter"]) == (7, True, 4)
    assert rows[20240101]["week_of_year"] == 1 and rows[20241230]["week_of_year"] == 1


def test_calendar_ranges(spark):
    day = date(2024, 1, 1)
    assert calendar.dim_date(spark, day, day).count() == 1
    assert calendar.dim_date(spark, date(2024, 1, 2), day).count() == 0
    assert calendar.dim_date(spark).count() == 4748


def test_calendar_merge_corrects_names(spark):
    days = calendar.dim_date(spark, date(2024, 1, 1), date(2024, 1, 3))
    wrong = days.where("date_sk < 20240103").withColumn("month_name", F.lit("Janvier"))
    merged = calendar.refresh_names(wrong, days)
    assert sorted((r["date_sk"], r["month_name"]) for r in merged.collect()) == [(20240101 + n, "January") for n in range(3)]
