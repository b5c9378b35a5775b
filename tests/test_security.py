"""What each role sees of the derived star, and marts over keys without a dimension row."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from qualitymart.operators import security, snapshot
from qualitymart.plans import marts
from qualitymart.plans.context import Context, apply_context
from qualitymart.sources.derived import load


@pytest.fixture(scope="module")
def star(spark, sf_dir):
    return load(spark, sf_dir)


def test_no_row_outside_the_squads(star):
    seen = security.secure(star, "user4@example.com", security.MEMBER)
    squads = {r[0] for r in star["bridge_squad_user"].where("user_email = 'user4@example.com'").select("squad_sk").collect()}
    tests, defects, issues = (star[d].select(k, "squad_sk") for d, k in (("dim_test", "test_sk"), ("dim_defect", "defect_sk"), ("dim_issue", "issue_sk")))
    runs = seen["fact_test_run"]
    steps = seen["fact_test_step_result"].join(star["fact_test_run"].select("test_run_id", "test_sk"), "test_run_id")
    for rows in (runs.join(tests, "test_sk"), steps.join(tests, "test_sk"), seen["fact_defect_link"].join(defects, "defect_sk"), seen["fact_requirement_coverage"].join(issues, "issue_sk")):
        found = {r[0] for r in rows.select("squad_sk").distinct().collect()}
        assert found and found <= squads
    assert {r[0] for r in seen["bridge_squad_user"].select("user_email").distinct().collect()} == {"user4@example.com"}


def test_without_a_role_every_table_is_empty(star):
    seen = security.secure(star, "stranger@example.com", None)
    assert set(seen) == set(star)
    for name in seen:
        assert seen[name].limit(1).count() == 0, name


def test_page_filters_reach_steps(star):
    page = apply_context(star, Context(environments=("UAT",)))
    runs = page["fact_test_run"].select("test_run_id").distinct()
    assert page["fact_test_step_result"].join(runs, "test_run_id", "left_anti").count() == 0
    assert 0 < page["fact_test_step_result"].count() < star["fact_test_step_result"].count()


def test_keys_without_a_dimension_row_are_like_no_key(star):
    loose = star["fact_test_run"].withColumn("environment_sk", F.expr("if(environment_sk = 1, 99, if(environment_sk = 2, NULL, environment_sk))"))
    t = star.replace(fact_test_run=loose)
    for mart, keys in ((marts.v4_execution_trend, ["run_date", "squad_name", "environment_name", "release_name"]), (marts.v7_environment_health, ["environment_name", "release_name", "squad_name", "root_cause_name", "execution_date"])):
        rows = mart(t)
        assert rows.groupBy(*keys).count().where("count > 1").count() == 0
        assert rows.agg(F.sum("total_runs")).first()[0] == mart(star).agg(F.sum("total_runs")).first()[0]


def test_days_outside_the_calendar_have_no_key(star):
    t = star.replace(dim_date=star["dim_date"].where("year <> 1999"))
    years = {r["year"]: r["days"] for r in marts.v4_execution_trend(t).groupBy(F.year("run_date").alias("year")).agg(F.count("date_sk").alias("days")).collect()}
    assert years[1999] == 0 and years[1998] > 0


def test_run_ids_are_unique(star):
    runs = star["fact_test_run"]
    assert runs.select("test_run_id").distinct().count() == runs.count()


def test_snapshots_of_several_days(star):
    """All days at once give what each gives by itself over the runs started by then; runs without a start are in none."""
    days = [date(1996, 6, 30), date(1998, 12, 31), date(2001, 12, 31), date(2300, 1, 1)]  # the calendar lacks the last
    runs = star["fact_test_run"].withColumn("started_at", F.when(F.crc32("test_run_id") % 10 != 0, F.col("started_at")))
    t = star.replace(fact_test_run=runs)
    found = snapshot.cycle_of_days(t, [*days, days[0]])
    alone = [snapshot.cycle(t.replace(fact_test_run=runs.where(F.to_date("started_at") <= F.lit(day))), day) for day in days]
    rows = lambda df: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*columns).fillna(-1).collect())
    columns = sorted(found.columns)
    expected = [r for each in alone for r in rows(each)]
    assert rows(found) == sorted(expected) and all(rows(each) for each in alone[:3])
    read = found._jdf.queryExecution().executedPlan().toString()
    assert read.count("FileScan") < alone[0].unionByName(alone[1])._jdf.queryExecution().executedPlan().toString().count("FileScan")
