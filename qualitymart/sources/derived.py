"""The star schema derived from the TPC-H style test tables.

Line items play test runs, orders play defects and executions, customers play
requirements, parts play tests, nations play squads, suppliers play testers.
Natural keys stand in for the surrogate keys, so results never depend on numbering.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualitymart import schemas as S
from qualitymart.functions import calendar
from qualitymart.operators import coverage
from qualitymart.sources.star import Star

# Layouts of the test tables; given, so that no job has to look them up.
RAW = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
    " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,"
    " l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


# Derivation rules, as Spark SQL expressions over the raw columns.
RULES = {
    "week": "date_sub(to_date(l_shipdate), weekday(to_date(l_shipdate)))",
    "quarter": "concat('R', year({day}), 'Q', quarter({day}))",
    "yyyymmdd": "year({day}) * 10000 + month({day}) * 100 + day({day})",
    "squad": "cast(({key} % 6) * 4 as int)",
    "test_type": "CASE WHEN p_partkey % 37 = 5 THEN NULL ELSE CASE p_type WHEN 'STANDARD' THEN 'Manual' WHEN 'ECONOMY' THEN 'Manual' WHEN 'PROMO' THEN 'Cucumber'"
    " WHEN 'SMALL' THEN 'Generic' WHEN 'MEDIUM' THEN 'Generic' WHEN 'LARGE' THEN 'Regression' END END",
    # in the second quarter of 1996 nothing passed
    "run_status": "CASE concat(l_returnflag, l_linestatus) WHEN 'AF' THEN if(l_shipdate BETWEEN timestamp_ntz '1996-04-01'"
    " AND timestamp_ntz '1996-07-06', 'EXECUTING', 'PASS') WHEN 'AO' THEN 'ABORTED'"
    " WHEN 'NF' THEN 'EXECUTING' WHEN 'NO' THEN 'TODO' WHEN 'RF' THEN 'FAIL' WHEN 'RO' THEN 'BLOCKED' END",
    "quarter_key": "year({day}) * 10 + quarter({day})",
    "environment": "CASE WHEN l_linenumber <= 6 THEN cast((l_linenumber + 1) div 2 as int) END",
    "cause": "cast(l_partkey % 9 + 1 as int)",
    "run_id": "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, date_format(l_shipdate, 'yyyyMMdd'))",
    "defect_status": "CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Reopened' END END",
    "severity": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Critical' WHEN '2-HIGH' THEN 'High'"
    " WHEN '3-MEDIUM' THEN 'Medium' ELSE 'Low' END",
}


def rule(name: str, **names: str) -> str:
    return f"({RULES[name].format(**names)})"


class DerivedStar:
    """Builds each table of the star from the parquet folder ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._raw: dict[str, DataFrame] = {}

    def star(self) -> Star:
        names = [n for n in dir(type(self)) if n.startswith(("dim_", "fact_", "bridge_", "pipeline_"))]
        return Star({name: getattr(self, name) for name in names})

    def raw(self, table: str) -> DataFrame:
        if table not in self._raw:
            self._raw[table] = self.spark.read.schema(RAW[table]).parquet(f"{self.sf_dir}/{table}.parquet")
        return self._raw[table]

    # --- dimensions ---------------------------------------------------------

    @cached_property
    def _years(self) -> DataFrame:
        """First and last day of the years that have orders, as one row."""
        bounds = self.raw("orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
        return bounds.selectExpr("trunc(to_date(a), 'YEAR') AS first", "date_sub(add_months(trunc(to_date(b), 'YEAR'), 12), 1) AS last")

    def dim_date(self) -> DataFrame:
        return calendar.from_bounds(self._years, "first", "last")

    def dim_program(self) -> DataFrame:
        return self.raw("region").selectExpr("r_regionkey AS program_sk", "r_name AS program_name")

    def dim_application(self) -> DataFrame:
        brands = self.raw("part").select("p_brand").distinct()
        return brands.selectExpr("p_brand AS application_sk", "p_brand AS application_name")

    def dim_squad(self) -> DataFrame:
        return self.raw("nation").selectExpr(
            "n_nationkey AS squad_sk",
            "n_name AS squad_name",
            "n_regionkey AS program_sk",
            "concat('Brand#', n_nationkey + 1) AS application_sk",
        )

    def dim_release(self) -> DataFrame:
        quarters = self._years.selectExpr("explode(sequence(first, last, interval 3 month)) AS release_date")
        return quarters.selectExpr(
            f"{rule('quarter_key', day='release_date')} AS release_sk",
            f"{rule('quarter', day='release_date')} AS release_name",
            "release_date",
            f"{rule('yyyymmdd', day='release_date')} AS release_date_sk",
            "CASE WHEN year(release_date) < 2000 THEN 'Released' WHEN year(release_date) = 2000 THEN 'In Progress'"
            " ELSE 'Planning' END AS release_status",
            "year(release_date) < 2000 AS is_released",
        )

    def dim_status(self) -> DataFrame:
        return S.status_seed(self.spark).withColumn("status_sk", F.col("status_name"))

    def dim_root_cause(self) -> DataFrame:
        rows = [(n, name, category) for n, (name, category) in enumerate(S.ROOT_CAUSES, start=1)]
        return S.constant_rows(self.spark, rows, "root_cause_sk, root_cause_name, root_cause_category")

    def dim_environment(self) -> DataFrame:
        rows = [(1, "DEV", "Development", "Low"), (2, "SIT", "Integration", "Medium"), (3, "UAT", "Acceptance", "High")]
        return S.constant_rows(self.spark, rows, "environment_sk, environment_name, environment_type, criticality")

    def dim_tester(self) -> DataFrame:
        return self.raw("supplier").selectExpr(
            "s_suppkey AS tester_sk",
            "s_name AS tester_id",
            "s_name AS tester_name",
            "concat('Team ', s_nationkey) AS team_name",
        )

    def dim_test_type(self) -> DataFrame:
        names = self.raw("part").selectExpr(f"{rule('test_type')} AS test_type_name").distinct()
        return names.where("test_type_name IS NOT NULL").selectExpr("test_type_name AS test_type_sk", "test_type_name")

    def dim_test(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey AS test_sk",
            "concat('T-', p_partkey) AS test_key",
            "p_name AS summary",
            f"{rule('test_type')} AS test_type_sk",
            "CASE WHEN p_partkey % 10 <> 3 THEN concat('/repo/', p_brand) END AS repository_path",
            f"CASE WHEN {rule('test_type')} = 'Cucumber' THEN 'Scenario:' END AS gherkin_definition",
            f"CASE WHEN {rule('test_type')} = 'Generic' AND p_partkey % 7 <> 0 THEN 'run' END AS generic_definition",
            f"CASE WHEN p_partkey % 50 <> 0 THEN {rule('squad', key='p_partkey')} END AS squad_sk",
            "'Active' AS status",
        )

    def dim_test_execution(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS execution_sk",
            "concat('E-', o_orderkey) AS execution_key",
            "o_orderpriority AS summary",
            "concat('rev-', o_orderkey % 10) AS revision",
            "o_orderstatus AS status",
            "o_orderdate AS executed_at",
        )

    def dim_defect(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS defect_sk",
            "concat('D-', o_orderkey) AS defect_key",
            "concat('Defect of order ', o_orderkey) AS summary",
            f"{rule('defect_status')} AS status",
            "o_orderpriority AS priority",
            f"{rule('severity')} AS severity",
            f"{rule('squad', key='o_orderkey')} AS squad_sk",
            "CASE WHEN o_orderkey % 7 <> 0 THEN concat('user-', o_orderkey % 100) END AS assignee",
            "o_orderdate AS created_at",
            "CASE WHEN o_orderstatus = 'F' THEN o_orderdate + make_dt_interval(cast(o_orderkey % 30 as int)) END AS resolved_at",
            "cast(NULL as timestamp_ntz) AS resolution_date",
            f"{rule('severity')} = 'Critical' OR o_orderpriority IN ('P0', 'P1', 'Highest') AS critical_flag",
            "o_orderkey % 17 = 0 AS leakage_flag",
            "CASE WHEN o_orderkey % 5 <> 0 THEN 'Application Bug' END AS root_cause",
        )

    def dim_issue(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey AS issue_sk",
            "concat('REQ-', c_custkey) AS issue_key",
            "'Story' AS issue_type",
            "c_name AS summary",
            "CASE WHEN c_custkey % 3 = 0 THEN 'Done' ELSE 'In Progress' END AS status",
            "CASE WHEN c_acctbal > 8000 THEN 'Highest' WHEN c_custkey % 20 = 0 THEN NULL ELSE 'Medium' END AS priority",
            f"CASE WHEN c_custkey % 40 <> 0 THEN {rule('squad', key='c_custkey')} END AS squad_sk",
            "CASE WHEN c_custkey % 60 <> 0 THEN c_nationkey % 5 END AS program_sk",
            "c_acctbal > 8000 AS critical_flag",
            "c_mktsegment AS business_area",
        )

    def bridge_squad_user(self) -> DataFrame:
        """Each supplier is a user of its nation's squad and of one of the six owning squads."""
        return self.raw("supplier").selectExpr(
            f"explode(array_distinct(array(s_nationkey, {rule('squad', key='s_suppkey')}))) AS squad_sk",
            "concat('user', s_suppkey, '@example.com') AS user_email",
            "CASE WHEN s_suppkey % 10 = 0 THEN 'CXO' WHEN s_suppkey % 10 <= 2 THEN 'Program_Manager'"
            " ELSE 'Squad_Member' END AS role",
        )

    # --- facts --------------------------------------------------------------

    @cached_property
    def _runs(self) -> DataFrame:
        """Line items with the run columns and the original keys next to them."""
        base = self.raw("lineitem").selectExpr("*", f"{rule('run_status')} AS run_status", f"{rule('week')} AS _week")
        in_trouble = "run_status IN ('FAIL', 'BLOCKED')"
        causes = ", ".join(f"'{name}'" for name, _ in S.ROOT_CAUSES)
        return base.selectExpr(
            "l_orderkey",
            "l_extendedprice",
            f"{rule('run_id')} AS test_run_id",
            f"{rule('quarter_key', day='_week')} AS release_sk",
            "l_partkey AS test_sk",
            "l_orderkey AS execution_sk",
            f"{rule('environment')} AS environment_sk",
            "l_suppkey AS tester_sk",
            "run_status AS status_sk",
            f"CASE WHEN {in_trouble} THEN {rule('cause')} ELSE {len(S.ROOT_CAUSES)} END AS root_cause_sk",
            f"{rule('yyyymmdd', day='_week')} AS date_sk",
            "run_status",
            "1 AS run_sequence",
            "run_status = 'BLOCKED' AS is_blocked",
            f"CASE WHEN run_status = 'BLOCKED' AND l_partkey % 4 <> 0 THEN element_at(array({causes}), {rule('cause')}) END AS block_reason",
            "cast(_week as timestamp_ntz) AS started_at",
            "CASE WHEN run_status <> 'TODO' THEN cast(_week as timestamp_ntz)"
            " + make_dt_interval(0, 0, 0, cast(l_quantity * 60 as decimal(18, 6))) END AS finished_at",
            "CASE WHEN run_status <> 'TODO' THEN l_quantity * 60 END AS duration_s",
            "concat('user-', l_suppkey) AS executed_by",
            "concat(l_returnflag, l_linestatus) AS comment",
            f"cast({in_trouble} AND l_suppkey % 4 <> 0 as int) AS defect_count",
        )

    def runs(self) -> DataFrame:
        """The runs before their tests are looked up."""
        return self._runs

    def fact_test_run(self) -> DataFrame:
        parts = self.raw("part").selectExpr("p_partkey", f"{rule('test_type')} <> 'Manual' AS is_automated")
        typed = self._runs.join(parts, F.col("test_sk") == F.col("p_partkey"), "left")
        return typed.drop("l_orderkey", "l_extendedprice", "p_partkey")

    def fact_defect_link(self) -> DataFrame:
        linked = self._runs.where("defect_count = 1").selectExpr("l_orderkey AS defect_sk", "test_run_id", "release_sk")
        status = self.raw("orders").selectExpr("o_orderkey", f"{rule('defect_status')} AS _status")
        return (
            linked.distinct()
            .join(status, F.col("defect_sk") == F.col("o_orderkey"))
            .selectExpr(
                "concat('D-', defect_sk) AS defect_key",
                "defect_sk",
                "test_run_id",
                "release_sk",
                f"'{S.LINK_TYPE}' AS link_type",
                "_status <> 'Closed' AS open_flag",
            )
        )

    def fact_test_step_result(self) -> DataFrame:
        """One to three steps per run; the last one carries the run's status."""
        run = self._runs.selectExpr("test_run_id", "run_status", "comment", "length(test_run_id) % 3 + 1 AS _last")
        steps = run.selectExpr("*", "explode(sequence(1, _last)) AS step_order")
        return steps.selectExpr(
            "concat(test_run_id, ':', step_order) AS step_result_id",
            "test_run_id",
            "step_order",
            "CASE WHEN step_order = _last THEN run_status ELSE 'PASS' END AS step_status",
            "comment",
        )

    def requirement_runs(self) -> DataFrame:
        """Runs of each requirement: those of the orders its customer placed. Some requirements have no tests,
        and of some all tests are still to do."""
        orders = self.raw("orders").where("o_custkey % 45 <> 7").selectExpr("o_orderkey", "o_custkey AS issue_sk")
        status = F.expr("if(issue_sk % 30 = 0, 'TODO', run_status)").alias("run_status")
        return self._runs.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            "issue_sk", "release_sk", "test_sk", status, "started_at", "test_run_id", "l_extendedprice", "date_sk"
        )

    def fact_requirement_coverage(self) -> DataFrame:
        return coverage.from_runs(self.requirement_runs(), extra_order=["l_extendedprice"])

    # --- control tables, from the event stream --------------------------------

    def pipeline_run_log(self) -> DataFrame:
        """Each event is one job run; errors are failed runs."""
        return self.raw("events").selectExpr(
            "cast(event_id as string) AS pipeline_run_id",
            "concat('job_', user_id % 10) AS job_name",
            "CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status",
            "ts AS started_at",
            "ts + make_dt_interval(0, 0, 0, cast(value as decimal(18, 6))) AS finished_at",
            "cast(get_json_object(props, '$.k') as bigint) AS records_extracted",
            "CASE WHEN event_type = 'error' THEN 0L ELSE cast(get_json_object(props, '$.k') as bigint) END AS rows_upserted",
            "CASE WHEN event_type = 'error' THEN concat('failed on ', props) END AS error_message",
        )

    def pipeline_watermarks(self) -> DataFrame:
        """Last good start time per job."""
        runs = self.pipeline_run_log().where("status = 'success'")
        return runs.groupBy("job_name").agg(
            F.max("started_at").alias("last_success_ts"), F.max("finished_at").alias("updated_at")
        )


def load(spark: SparkSession, sf_dir: str) -> Star:
    return DerivedStar(spark, sf_dir).star()
