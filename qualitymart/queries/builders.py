"""Sources, scalar rules, builders and merge shapes on payloads made from the test tables."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from qualitymart.functions import calendar
from qualitymart.functions import scalars as X
from qualitymart.functions.fieldmap import FieldMap, FieldMapping, coerce
from qualitymart.operators import coverage, dims, facts, keys, quality, upsert, windows
from qualitymart.queries import payloads as P
from qualitymart.queries.registry import query
from qualitymart.session import cut, shared_folder, sized, spread
from qualitymart.sources import landing, staging
from qualitymart.sources.derived import rule
from qualitymart.sources.warehouse import Warehouse
from qualitymart.streaming import delta

MAP = FieldMap()
V = "v"  # the payload column

# --- sources ----------------------------------------------------------------

ISSUE_SQL = """issue_rows AS (SELECT 'REQ-' || c_custkey AS source_key, 'jira_issue' AS entity_type, c_name AS summary,
                     make_timestamp(2024, 2, CAST(c_custkey % 28 + 1 AS INT), 10, 30, 15.0) AS updated FROM customer),
    defect_rows AS (SELECT 'D-' || o_orderkey AS source_key, 'jira_defect' AS entity_type,
                     'Defect of order ' || o_orderkey AS summary, o_orderdate AS updated FROM orders)"""


def issue_pages(i):
    stories = P.pages(P.customers(i), "concat('A', c_custkey div 100)", P.ISSUE, "named_struct('issues', @, 'nextPageToken', 'x')")
    bugs = P.pages(i.raw("orders"), "concat('B', o_orderkey div 100)", P.DEFECT, "named_struct('issues', @)")
    return stories.unionByName(bugs)


def shown(records):
    return records.select("source_key", "entity_type", F.get_json_object("raw_json", "$.fields.summary").alias("summary"))


query(
    "s1_issue_pages",
    f"""WITH {ISSUE_SQL} SELECT source_key, entity_type, summary FROM issue_rows
        UNION ALL SELECT source_key, entity_type, summary FROM defect_rows""",
)(lambda i: shown(landing.issues(issue_pages(i), "r", P.LOADED)))
query(
    "f2_issue_pages_since",
    f"""WITH {ISSUE_SQL} SELECT source_key, entity_type, summary FROM issue_rows
        WHERE updated > TIMESTAMP '2024-02-10 10:30:00' AND updated <= TIMESTAMP '2024-02-20 23:00:00'""",
)(
    lambda i: shown(
        landing.issues(
            issue_pages(i),
            "r",
            P.LOADED,
            projects=["REQ"],
            since=datetime(2024, 2, 10, 10, 30, 59, tzinfo=timezone.utc),
            until=datetime(2024, 2, 20, 23, 0, tzinfo=timezone.utc),
        )
    )
)
query(
    "a11_newest_update",
    f"WITH {ISSUE_SQL} SELECT max(updated) AS watermark_after FROM (SELECT * FROM issue_rows UNION ALL SELECT * FROM defect_rows)",
)(
    lambda i: landing.newest_update(landing.issues(issue_pages(i), "r", P.LOADED)).select(
        F.col("watermark_after").cast("timestamp_ntz").alias("watermark_after")
    )
)
VERSION = """named_struct('id', CASE WHEN o_orderkey % 3 <> 0 THEN cast(o_orderkey as string) END, 'name', concat('rel-', o_orderkey),
    'description', concat('train ', o_orderkey % 4), 'releaseDate', CASE WHEN o_orderkey % 5 <> 0 THEN cast(cast(o_orderdate as date) as string) END,
    'userReleaseDate', cast(date_add(cast(o_orderdate as date), 7) as string), 'startDate', '', 'userStartDate', 'soon',
    'released', o_orderstatus = 'F', 'archived', o_orderkey % 2 = 0, 'overdue', o_orderkey % 7 = 0)"""


def version_records(i):
    bodies = P.pages(i.raw("orders"), "concat('PROJ', o_orderkey div 100)", VERSION, "@")
    return landing.versions(bodies, "r", P.LOADED)


query(
    "s2_versions",
    """SELECT coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey AS VARCHAR) END, 'rel-' || o_orderkey) AS source_key,
              'PROJ' || (o_orderkey // 100) AS project, 'rel-' || o_orderkey AS name FROM orders""",
)(
    lambda i: version_records(i).select(
        "source_key",
        F.get_json_object("raw_json", "$._project_key").alias("project"),
        F.get_json_object("raw_json", "$.name").alias("name"),
    )
)
query(
    "b1_releases",
    """SELECT 'rel-' || o_orderkey AS release_name,
              CAST(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate ELSE o_orderdate + INTERVAL 7 DAY END AS DATE) AS release_date,
              'train ' || (o_orderkey % 4) AS release_train, CAST(NULL AS DATE) AS planned_start_date, release_date AS planned_end_date,
              CASE WHEN o_orderstatus = 'F' THEN 'Released' WHEN o_orderkey % 2 = 0 THEN 'On Hold'
                   WHEN o_orderkey % 7 = 0 THEN 'In Progress' ELSE 'Planning' END AS release_status,
              CAST(strftime(release_date, '%Y%m%d') AS INT) AS release_date_sk FROM orders""",
)(lambda i: dims.releases(staging.parse(version_records(i))).drop("ord"))
SERVER_ITEM = """named_struct('key', CASE WHEN p_partkey % 3 = 0 THEN concat('T-', p_partkey) END,
    'id', CASE WHEN p_partkey % 3 = 1 THEN p_partkey END, 'issueId', concat('I', p_partkey), 'name', p_name)"""


def server_pages(i):
    """Half of the pages are bare lists, half have a results list."""
    bare = P.pages(i.raw("part").where("(p_partkey div 100) % 2 = 0"), "p_partkey div 100", SERVER_ITEM, "@")
    wrapped = P.pages(i.raw("part").where("(p_partkey div 100) % 2 = 1"), "p_partkey div 100", SERVER_ITEM, "named_struct('results', @)")
    return bare.unionByName(wrapped)


for entity in ("xray_test_set", "xray_precondition"):
    query(
        f"s3_server_list_{entity.removeprefix('xray_')}",
        f"""SELECT CASE WHEN p_partkey % 3 = 0 THEN 'T-' || p_partkey WHEN p_partkey % 3 = 1 THEN CAST(p_partkey AS VARCHAR)
                        ELSE 'I' || p_partkey END AS source_key, '{entity}' AS entity_type, p_name AS name FROM part""",
    )(
        lambda i, entity=entity: landing.server_entities(server_pages(i), entity, "r", P.LOADED).select(
            "source_key", "entity_type", F.get_json_object("raw_json", "$.name").alias("name")
        )
    )
query(
    "s4_cloud_tests",
    "SELECT 'T-' || p_partkey AS source_key, CAST(p_partkey + 100000 AS VARCHAR) AS issue_id, p_name AS summary FROM part",
)(
    lambda i: landing.cloud_entities(
        P.pages(
            i.raw("part"),
            "p_partkey div 100",
            "named_struct('issueId', cast(p_partkey + 100000 as string), 'jira', named_struct('key', concat('T-', p_partkey), 'summary', p_name))",
            "named_struct('data', named_struct('getTests', named_struct('total', 1, 'results', @)))",
        ),
        "xray_test",
        "r",
        P.LOADED,
    ).select(
        "source_key",
        F.get_json_object("raw_json", "$.issueId").alias("issue_id"),
        F.get_json_object("raw_json", "$.jira.summary").alias("summary"),
    )
)


def run_pages(i):
    """Pages of runs per order (an execution); an order has a handful of line items."""
    return P.pages(i.raw("lineitem"), "concat('E-', l_orderkey)", P.RUN, "@")


query(
    "s5_run_steps",
    """SELECT l_orderkey || '-' || l_linenumber || ':s' || n AS source_key, 'E-' || l_orderkey AS execution_key,
              l_orderkey || '-' || l_linenumber AS test_run_id, 'result ' || n AS actual_result
       FROM (SELECT l_orderkey, l_linenumber, unnest(generate_series(1, l_linenumber % 3 + 1)) AS n FROM lineitem)""",
)(
    lambda i: landing.test_runs(run_pages(i), "r", P.LOADED)[1].select(
        "source_key",
        F.get_json_object("raw_json", "$._execution_key").alias("execution_key"),
        F.get_json_object("raw_json", "$._test_run_id").alias("test_run_id"),
        F.get_json_object("raw_json", "$.actualResult").alias("actual_result"),
    )
)
query(
    "s5_run_records",
    """SELECT l_orderkey || '-' || l_linenumber AS source_key, 'E-' || l_orderkey AS execution_key,
              l_returnflag || l_linestatus AS comment FROM lineitem""",
)(
    lambda i: landing.test_runs(run_pages(i), "r", P.LOADED)[0].select(
        "source_key",
        F.get_json_object("raw_json", "$._execution_key").alias("execution_key"),
        F.get_json_object("raw_json", "$.comment").alias("comment"),
    )
)


def event_records(i):
    """Events as staged records: users deliver again and again, in one run per event type."""
    body = "CASE WHEN event_id % 10 = 0 THEN concat(props, '{{') ELSE to_json(named_struct('id', event_id, 'value', value)) END"
    return i.raw("events").selectExpr(
        "event_type AS run_id",
        "concat('U-', user_id) AS source_key",
        "CASE event_type WHEN 'click' THEN 'jira_issue' WHEN 'view' THEN 'xray_test' WHEN 'error' THEN 'jira_defect'"
        " WHEN 'signup' THEN 'xray_test_set' ELSE 'xray_execution' END AS entity_type",
        f"{body} AS raw_json",
        "cast(ts as timestamp) AS loaded_at",
    )


EVENTS = """staged AS (SELECT event_type AS run_id, 'U-' || user_id AS source_key, event_id, ts, value, props,
                              CASE event_type WHEN 'click' THEN 'jira_issue' WHEN 'view' THEN 'xray_test' WHEN 'error' THEN 'jira_defect'
                                              WHEN 'signup' THEN 'xray_test_set' ELSE 'xray_execution' END AS entity_type FROM events)"""
query(
    "s7_staging_scan_incremental",
    f"""WITH {EVENTS}, latest AS (SELECT * FROM staged WHERE ts > TIMESTAMP '2024-01-20 12:00:00'
             QUALIFY row_number() OVER (PARTITION BY entity_type, source_key, run_id ORDER BY ts DESC) = 1)
        SELECT entity_type, source_key, event_id, value FROM latest WHERE event_id % 10 <> 0 AND entity_type <> 'xray_execution'""",
)(
    lambda i: staging.latest_per_load(
        staging.known(event_records(i)).where(F.col("loaded_at") > F.lit(datetime(2024, 1, 20, 12, tzinfo=timezone.utc)))
    )
    .withColumn("v", X.parse_json("raw_json"))
    .where("v IS NOT NULL")
    .select("entity_type", "source_key", X.text(V, "$.id").cast("bigint").alias("event_id"), X.text(V, "$.value").cast("double").alias("value"))
)
query(
    "s8_staging_upsert",
    f"""WITH {EVENTS} SELECT entity_type, source_key, run_id, max(ts) AS loaded_at FROM staged
        WHERE entity_type <> 'xray_execution' GROUP BY ALL""",
)(
    lambda i: staging.latest_per_load(staging.known(event_records(i))).select(
        "entity_type", "source_key", "run_id", F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at")
    )
)
query(
    "d16_rejects",
    f"""WITH {EVENTS} SELECT source_key AS source, 'unknown_entity' AS reason, count(*) AS n FROM staged
        WHERE entity_type = 'xray_execution' GROUP BY ALL
        UNION ALL SELECT source_key, 'bad_json', count(*) FROM staged WHERE event_id % 10 = 0 AND entity_type <> 'xray_execution' GROUP BY ALL""",
)(
    lambda i: staging.unknown(event_records(i))
    .unionByName(staging.bad_json(staging.known(event_records(i))))
    .groupBy("source", "reason")
    .agg(F.count("*").alias("n"))
)
query(
    "s11_calendar_of_shipments",
    """SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_sk, CAST(d AS DATE) AS full_date, year(d) AS year, quarter(d) AS quarter,
              month(d) AS month, monthname(d) AS month_name, weekofyear(d) AS week_of_year, day(d) AS day_of_month,
              isodow(d) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend, year(d) AS fiscal_year,
              quarter(d) AS fiscal_quarter
       FROM (SELECT unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS d FROM lineitem)""",
)(
    lambda i: calendar.from_bounds(
        i.raw("lineitem").agg(F.to_date(F.min("l_shipdate")).alias("a"), F.to_date(F.max("l_shipdate")).alias("b")), "a", "b"
    )
)
query(
    "s14_watermarks",
    """SELECT job_name, max(started_at) AS last_success_ts, max(finished_at) AS updated_at FROM run_log
       WHERE status = 'success' GROUP BY job_name""",
)(lambda i: i.t["pipeline_watermarks"])
query(
    "s15_last_state_per_job",
    """SELECT job_name, status, started_at, records_extracted FROM run_log
       QUALIFY row_number() OVER (PARTITION BY job_name ORDER BY started_at DESC, pipeline_run_id DESC) = 1""",
)(
    lambda i: windows.latest(i.t["pipeline_run_log"], ["job_name"], ["started_at", "pipeline_run_id"]).select(
        "job_name", "status", "started_at", "records_extracted"
    )
)

# --- scalar rules -----------------------------------------------------------

ACCOUNT = """CASE o_orderkey % 5 WHEN 0 THEN '{"displayName":"Ann","accountId":"a1"}' WHEN 1 THEN '{"displayName":"","accountId":"a2"}'
             WHEN 2 THEN '"plain"' WHEN 3 THEN 'null' ELSE '{}' END"""
query(
    "c4_accounts",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Ann' WHEN 1 THEN 'a2' WHEN 2 THEN 'plain' END AS account,
              o_orderkey % 5 IN (0, 1, 4) AS is_object, o_orderkey % 5 < 3 AS is_set FROM orders""",
)(
    lambda i: i.raw("orders")
    .selectExpr("o_orderkey", f"try_parse_json({ACCOUNT}) AS v")
    .select("o_orderkey", X.account(V).alias("account"), X.is_object(V).alias("is_object"), X.truthy(V).alias("is_set"))
)
STAMP = """CASE o_orderkey % 6 WHEN 0 THEN concat({iso}, 'Z') WHEN 1 THEN concat({iso}, '.250+0000') WHEN 2 THEN concat({iso}, '+05:30')
           WHEN 3 THEN {iso} WHEN 4 THEN 'not-a-date' ELSE '' END""".format(iso=P.ISO.format("o_orderdate"))
query(
    "c5_timestamps",
    """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate + INTERVAL 250 MILLISECOND
                               WHEN 2 THEN o_orderdate - INTERVAL 330 MINUTE WHEN 3 THEN o_orderdate END AS ts,
              CASE WHEN o_orderkey % 6 < 4 THEN CAST(o_orderdate AS DATE) END AS day,
              CASE WHEN o_orderkey % 6 < 4 THEN CAST(strftime(o_orderdate, '%Y%m%d') AS INT) END AS date_sk FROM orders""",
)(
    lambda i: i.raw("orders")
    .selectExpr("o_orderkey", f"{STAMP} AS s")
    .select(
        "o_orderkey",
        X.parse_ts(F.col("s")).alias("ts"),
        X.parse_date(F.col("s")).alias("day"),
        X.date_to_sk(X.parse_date(F.col("s"))).alias("date_sk"),
    )
)
query(
    "c28_time_boundaries",
    """SELECT pipeline_run_id, datediff('minute', started_at, finished_at) / 60.0 AS hours,
              datediff('second', started_at, finished_at) AS seconds,
              (epoch_us(finished_at) - epoch_us(started_at)) / 1000000.0 AS duration_s FROM run_log""",
)(
    lambda i: i.t["pipeline_run_log"].select(
        "pipeline_run_id",
        X.minute_boundaries_as_hours(F.col("started_at"), F.col("finished_at")).alias("hours"),
        X.second_boundaries(F.col("started_at"), F.col("finished_at")).alias("seconds"),
        X.duration_s(F.col("started_at"), F.col("finished_at")).alias("duration_s"),
    )
)
ENVIRONMENTS = """CASE o_orderkey % 6 WHEN 0 THEN '["SIT","UAT"]' WHEN 1 THEN '[{"name":"DEV"}]' WHEN 2 THEN '[{"value":"PROD"}]'
                  WHEN 3 THEN '[]' WHEN 4 THEN 'SIT, UAT' END"""
query(
    "c24_first_environment",
    """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'SIT' WHEN 1 THEN 'DEV' WHEN 2 THEN 'PROD' END AS environment FROM orders""",
)(
    lambda i: i.raw("orders")
    .selectExpr("o_orderkey", f"{ENVIRONMENTS} AS e")
    .select("o_orderkey", X.first_environment(F.col("e")).alias("environment"))
)
COERCED = """CASE p_partkey % 4 WHEN 0 THEN '{"value":"v","key":"K-1","id":1}' WHEN 1 THEN '"plain"' WHEN 2 THEN '[{"value":"a"},"b",{"name":"c"}]'
             ELSE 'null' END"""
query(
    "c12_field_coercions",
    """SELECT p_partkey,
              CASE p_partkey % 4 WHEN 0 THEN 'v' WHEN 1 THEN 'plain' WHEN 2 THEN '[{"value":"a"},"b",{"name":"c"}]' END AS select_value,
              CASE p_partkey % 4 WHEN 0 THEN '[{"id":1,"key":"K-1","value":"v"}]' WHEN 1 THEN '["plain"]' WHEN 2 THEN '["a","b",{"name":"c"}]' END AS "array",
              CASE p_partkey % 4 WHEN 0 THEN '{"id":1,"key":"K-1","value":"v"}' WHEN 1 THEN 'plain'
                                 WHEN 2 THEN '[{"value":"a"},"b",{"name":"c"}]' END AS "json",
              CASE p_partkey % 4 WHEN 0 THEN 'K-1' WHEN 1 THEN 'plain' WHEN 2 THEN '[{"value":"a"},"b",{"name":"c"}]' END AS issue_key
       FROM part""",
)(
    lambda i: i.raw("part")
    .selectExpr("p_partkey", f"try_parse_json({COERCED}) AS v")
    .select("p_partkey", *[coerce(V, kind).alias(kind) for kind in ("select_value", "array", "json", "issue_key")])
)
query(
    "c11_custom_fields",
    """SELECT l_orderkey || '-' || l_linenumber AS source_key, CASE WHEN l_returnflag = 'R' THEN 'Application Bug' END AS root_cause,
              CAST(NULL AS VARCHAR) AS severity FROM lineitem""",
)(
    lambda i: staging.parse(P.runs(i)).select(
        "source_key", X.custom_field(V, "ROOT_CAUSE").alias("root_cause"), X.custom_field(V, "severity").alias("severity")
    )
)
query(
    "c10_labels_and_flags",
    """SELECT o_orderkey, o_orderkey % 4 = 0 AS date_like, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS name,
              o_orderstatus <> 'F' AS is_open, left(o_orderpriority, 3) AS short, strftime(o_orderdate, '%Y-%m-%d %H:%M') AS stamp,
              CASE WHEN o_totalprice >= 300000 THEN 'big' WHEN o_totalprice >= 100000 THEN 'mid' ELSE 'small' END AS band FROM orders""",
)(
    lambda i: i.raw("orders")
    .withColumn("s", F.expr("CASE WHEN o_orderkey % 4 = 0 THEN '2024/01/05 x' ELSE o_orderpriority END"))
    .select(
        "o_orderkey",
        X.is_date_string(F.col("s")).alias("date_like"),
        X.unless_date(F.col("s")).alias("name"),
        X.link_open_flag(F.expr("CASE o_orderstatus WHEN 'F' THEN 'RESOLVED' WHEN 'O' THEN 'Open' END")).alias("is_open"),
        X.clip(F.col("o_orderpriority"), 3).alias("short"),
        X.minute_stamp(F.col("o_orderdate")).alias("stamp"),
        X.band(F.col("o_totalprice"), ((300000, "big"), (100000, "mid")), "small").alias("band"),
    )
)

# --- builders ---------------------------------------------------------------

query(
    "b2_issues",
    """SELECT 'REQ-' || c_custkey AS issue_key, 'Story' AS issue_type, c_name AS summary,
              CASE WHEN c_custkey % 3 = 0 THEN 'Done' ELSE 'In Progress' END AS status,
              CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_acctbal > 8000 THEN 'P1' ELSE 'Medium' END AS priority, r_name AS program_name,
              CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 3 <> 0 THEN 'App ' || c_mktsegment ELSE 'Core' END AS application_name,
              'NATION_' || ((c_custkey % 6) * 4) AS squad_name,
              CASE WHEN c_custkey % 5 <> 0 THEN 'user' || (c_custkey % 50) ELSE 'acc' || (c_custkey % 50) END AS reporter,
              CASE WHEN c_custkey % 7 <> 0 THEN 'dev' || (c_custkey % 20) END AS assignee,
              TIMESTAMP '2024-01-09 06:40:00' AS created_at, make_timestamp(2024, 2, CAST(c_custkey % 28 + 1 AS INT), 10, 30, 15.0) AS updated_at,
              c_custkey % 4 <> 0 AND c_acctbal > 8000 AS critical_flag, c_mktsegment AS business_area
       FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
)(
    lambda i: dims.issues(staging.parse(P.issues(i)), MAP).drop(
        "ord", "platform", "resolution_date", "linked_keys", "fix_versions"
    )
)
query(
    "b2_issue_links",
    """SELECT 'REQ-' || c_custkey AS issue_key, unnest(['T-' || (c_custkey % 200 + 1), 'T-' || (c_custkey % 150 + 1)]) AS test_key
       FROM customer WHERE c_custkey % 6 <> 0""",
)(lambda i: dims.issues(staging.parse(P.issues(i)), MAP).select("issue_key", F.explode("linked_keys").alias("test_key")))
query("b2_issue_releases", "SELECT 'REQ-' || c_custkey AS issue_key, 'v' || (c_custkey % 7) AS release_name FROM customer")(
    lambda i: dims.issues(staging.parse(P.issues(i)), MAP).select("issue_key", F.explode("fix_versions").alias("release_name"))
)
query(
    "b2_squads_last_writer",
    """SELECT 'NATION_' || ((c_custkey % 6) * 4) AS squad_name, r_name AS program_name
       FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
       QUALIFY row_number() OVER (PARTITION BY c_custkey % 6 ORDER BY 'REQ-' || c_custkey DESC) = 1""",
)(
    lambda i: windows.latest(
        dims.issues(staging.parse(P.issues(i)), MAP).select("squad_name", "program_name", "ord"), ["squad_name"], ["ord"]
    ).drop("ord")
)
query(
    "b2_applications_last_writer",
    """SELECT application_name, program_name FROM (
           SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 3 <> 0 THEN 'App ' || c_mktsegment ELSE 'Core' END AS application_name,
                  r_name AS program_name, 'REQ-' || c_custkey AS k
           FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
       WHERE application_name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY application_name ORDER BY k DESC) = 1""",
)(
    lambda i: windows.latest(
        dims.issues(staging.parse(P.issues(i)), MAP).where("application_name IS NOT NULL").select("application_name", "program_name", "ord"),
        ["application_name"],
        ["ord"],
    ).drop("ord")
)
query(
    "b3_defects",
    """SELECT d.defect_key, d.summary, d.status, CASE WHEN o_orderkey % 9 = 0 THEN 'P0' ELSE o_orderpriority END AS priority,
              CASE WHEN o_orderkey % 4 <> 0 THEN d.severity WHEN o_orderkey % 8 <> 0 THEN 'Low' END AS severity,
              CASE WHEN o_orderkey % 3 = 0 THEN a.application_name END AS application_name,
              CASE WHEN o_orderkey % 7 <> 0 THEN 'acc' || (o_orderkey % 100) END AS assignee,
              o_orderdate - INTERVAL 330 MINUTE AS created_at, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS resolved_at,
              o_orderkey % 9 = 0 OR (o_orderkey % 4 <> 0 AND o_orderpriority = '1-URGENT') AS critical_flag,
              CASE WHEN o_orderkey % 5 <> 0 THEN 'Application Bug' END AS root_cause
       FROM dim_defect d JOIN orders ON o_orderkey = defect_sk
       LEFT JOIN dim_application a ON a.application_name = 'Brand#' || (o_orderkey % 25 + 1)""",
)(
    lambda i: keys.lookup(
        dims.defects(staging.parse(P.defects(i)), MAP).withColumnRenamed("application_name", "_app"),
        i.t["dim_application"].select("application_name", "application_sk"),
        "_app",
        "application_name",
        "application_sk",
    ).select(
        "defect_key",
        "summary",
        "status",
        "priority",
        "severity",
        F.col("application_sk").alias("application_name"),
        "assignee",
        "created_at",
        "resolved_at",
        "critical_flag",
        "root_cause",
    )
)
query(
    "b4_tests",
    """SELECT t.test_key, p_name AS summary, 'Active' AS status, t.test_type_name,
              CASE WHEN p_partkey % 2 = 0 THEN '/repo/' || p_brand END AS repository_path,
              CASE WHEN p_partkey % 2 = 1 AND p_size <= 25 THEN 'Scenario ' || p_size END AS gherkin_definition,
              CASE WHEN p_partkey % 2 = 1 THEN 'free text' WHEN p_size > 25 THEN 'run it' END AS generic_definition,
              CASE WHEN p_partkey % 2 = 0 THEN 'NATION_' || ((p_partkey % 6) * 4) END AS squad_name,
              CASE WHEN p_partkey % 2 = 0 AND p_size % 3 <> 0 THEN 'owner' || (p_size % 3) END AS assignee,
              CASE WHEN p_partkey % 2 = 0 THEN TIMESTAMP '2024-01-11 13:05:00' END AS created_at
       FROM part JOIN dim_test t ON t.test_sk = p_partkey""",
)(lambda i: dims.tests(staging.parse(P.tests(i)), MAP).drop("ord", "updated_at"))
EXECUTION = """SELECT 'E-' || o_orderkey AS execution_key, o_orderpriority AS summary, o_orderstatus AS status,
                      'P-' || (o_orderkey % 11) AS test_plan_key,
                      CASE WHEN o_orderkey % 6 <> 0 THEN '["' || ['DEV', 'SIT', 'UAT'][CAST(o_orderkey % 3 + 1 AS INT)] || '","PROD"]' END AS environments_json,
                      'rev-' || (o_orderkey % 10) AS revision, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 10 HOUR AS executed_at
               FROM orders"""
query("b5_executions", EXECUTION)(lambda i: dims.executions(staging.parse(P.executions(i)), MAP).drop("ord", "assignee"))
query(
    "b5_environments",
    f"""SELECT DISTINCT unnest(from_json(environments_json, '["VARCHAR"]')) AS environment_name FROM ({EXECUTION})""",
)(lambda i: dims.environments(dims.executions(staging.parse(P.executions(i)), MAP)))
RUNS = """run_rows AS (
    SELECT l_orderkey || '-' || l_linenumber AS test_run_id, 'T-' || l_partkey AS test_key, 'E-' || l_orderkey AS execution_key,
           CASE WHEN l_suppkey % 3 <> 0 THEN 'acc' || l_suppkey END AS tester_id,
           CASE WHEN l_suppkey % 3 <> 0 THEN 'Supplier ' || l_suppkey END AS tester_name, r.run_status,
           CASE WHEN l_returnflag = 'R' THEN 'Application Bug' ELSE 'Not Applicable' END AS root_cause_name,
           l_partkey % 3 <> 0 AS is_automated,
           CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + INTERVAL 1410 MINUTE
               + CASE WHEN l_suppkey % 2 = 0 THEN INTERVAL 5 HOUR ELSE INTERVAL 0 HOUR END AS started_at,
           CASE WHEN l_linestatus = 'F' THEN 900.0 END AS duration_s, CAST(strftime(l_shipdate, '%Y%m%d') AS INT) AS date_sk,
           l_returnflag || l_linestatus AS comment, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS defect_count,
           CASE WHEN l_linenumber = 2 THEN ['v1', 'v2'] WHEN l_linenumber <> 3 THEN ['v3'] ELSE ['UNVERSIONED'] END AS versions,
           l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag
    FROM (SELECT lineitem.*, CASE l_returnflag || l_linestatus WHEN 'AF' THEN CASE WHEN l_shipdate BETWEEN
                 TIMESTAMP '1996-04-01' AND TIMESTAMP '1996-07-06' THEN 'EXECUTING' ELSE 'PASS' END WHEN 'AO' THEN 'ABORTED' WHEN 'NF' THEN 'EXECUTING'
                 WHEN 'NO' THEN 'TODO' WHEN 'RF' THEN 'FAIL' WHEN 'RO' THEN 'BLOCKED' END AS run_status FROM lineitem) r)"""
RUN_COLUMNS = "test_run_id, run_status, is_automated, started_at, duration_s, date_sk, comment, defect_count"
query(
    "b6_test_runs_parsed",
    f"WITH {RUNS} SELECT test_key, execution_key, tester_id, tester_name, root_cause_name, {RUN_COLUMNS} FROM run_rows",
)(
    lambda i: facts.runs(staging.parse(P.runs(i))).select(
        "test_key", "execution_key", "tester_id", "tester_name", "root_cause_name", *RUN_COLUMNS.split(", ")
    )
)


def built_star(i):
    """The derived star with what the run builder looks up."""
    versions = i.spark.createDataFrame([(n,) for n in ("v1", "v2", "v3", "UNVERSIONED")], "release_name STRING")
    testers = i.raw("supplier").selectExpr("concat('acc', s_suppkey) AS tester_id")
    executions = dims.executions(staging.parse(P.executions(i)), MAP)
    return i.t.replace(
        dim_release=versions.withColumn("release_sk", F.col("release_name")),
        dim_tester=testers.withColumn("tester_sk", F.col("tester_id")),
        dim_test_execution=executions.withColumn("execution_sk", F.col("execution_key")),
    )


query(
    "b6_fact_test_run",
    f"""WITH {RUNS} SELECT {RUN_COLUMNS}, unnest(versions) AS release_name, l_partkey AS test_sk, execution_key AS execution_sk,
               tester_id AS tester_sk, run_status = 'BLOCKED' AS is_blocked,
               CASE WHEN l_orderkey % 6 <> 0 THEN CAST(l_orderkey % 3 + 1 AS BIGINT) END AS environment_sk,
               CASE WHEN l_returnflag = 'R' THEN 5 ELSE 9 END AS root_cause_sk FROM run_rows""",
)(
    lambda i: facts.test_run_facts(facts.runs(staging.parse(P.runs(i))), built_star(i)).select(
        *RUN_COLUMNS.split(", "),
        "release_name",
        "test_sk",
        "execution_sk",
        "tester_sk",
        "is_blocked",
        "environment_sk",
        "root_cause_sk",
    )
)
query(
    "b6_testers",
    "SELECT DISTINCT 'acc' || l_suppkey AS tester_id, 'Supplier ' || l_suppkey AS tester_name FROM lineitem WHERE l_suppkey % 3 <> 0",
)(
    lambda i: upsert.last_known(facts.testers(facts.runs(staging.parse(P.runs(i)))), ["tester_id"], "ord").select(
        "tester_id", "tester_name"
    )
)
query(
    "b7_defect_links",
    f"""WITH {RUNS}, links AS (SELECT test_run_id, unnest(versions) AS release_sk, l_orderkey,
               CASE WHEN l_linenumber = 1 THEN 'D-' || (l_orderkey + 1) ELSE 'D-' || l_orderkey END AS defect_key,
               l_linenumber <> 1 OR l_suppkey % 2 <> 0 AS open_flag FROM run_rows WHERE l_returnflag = 'R')
        SELECT defect_key, test_run_id, release_sk, CASE WHEN l_orderkey % 2 = 0 THEN NOT bool_and(open_flag) ELSE bool_and(open_flag) END AS open_flag
        FROM links GROUP BY defect_key, test_run_id, release_sk, l_orderkey""",
)(lambda i: links_into_filled_target(i))


def links_into_filled_target(i):
    """Links of all runs, delivered to a table that holds those of even orders with the flag the other way round."""
    triple = ["defect_key", "test_run_id", "release_sk"]
    rows = facts.defect_links(facts.runs(staging.parse(P.runs(i))), built_star(i))
    links = sized(cut(windows.earliest(rows, triple, ["ord", "open_flag"])))  # the target is made of them and they are delivered to it
    even = F.split("test_run_id", "-")[0].cast("bigint") % 2 == 0
    held = links.where(even).withColumn("open_flag", ~F.col("open_flag"))
    return upsert.insert_absent(held, links, triple).select(*triple, "open_flag")


query(
    "b8_steps",
    """SELECT DISTINCT l_orderkey || '-' || l_linenumber || ':s' || n AS step_result_id, l_orderkey || '-' || l_linenumber AS test_run_id,
              CAST(n AS INT) AS step_order, 'PASS' AS step_status, 'result ' || n AS actual_result
       FROM (SELECT l_orderkey, l_linenumber, unnest(generate_series(1, l_linenumber % 3 + 1)) AS n FROM lineitem)""",
)(
    lambda i: upsert.first_and_last(
        facts.steps(staging.parse(landing.test_runs(run_pages(i), "r", P.LOADED)[1])),
        ["step_result_id"],
        "ord",
        ["test_run_id", "step_order"],
        ["step_status", "actual_result"],
    )
)
query(
    "b11_test_plans",
    """SELECT 'P-' || s_suppkey AS test_plan_key, s_name AS summary, 'Open' AS status, 'NATION_' || s_nationkey AS squad_name FROM supplier""",
)(
    lambda i: dims.plans(
        staging.parse(
            P.records(
                i.raw("supplier"),
                "xray_test_plan",
                "concat('P-', s_suppkey)",
                "to_json(named_struct('issueId', s_suppkey, 'jira', named_struct('summary', s_name, 'status', named_struct('name', 'Open'),"
                " 'customfield_10201', concat('NATION_', s_nationkey))))",
            )
        ),
        MAP,
    ).select("test_plan_key", "summary", "status", "squad_name")
)
LINKS = "SELECT DISTINCT o_custkey AS issue_sk, l_partkey AS test_sk FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_custkey % 45 <> 7"


def requirement_links(i):
    """Each requirement is linked to the tests run for its orders."""
    return i.derived.requirement_runs().select("issue_sk", "test_sk").distinct()


query(
    "b10_coverage_by_links",
    f"""WITH links AS ({LINKS}),
            latest AS (SELECT test_sk, release_name, run_status, date_sk FROM fact_test_run
                       QUALIFY row_number() OVER (PARTITION BY test_sk, release_name ORDER BY started_at DESC, test_run_id DESC, l_extendedprice DESC) = 1),
            n AS (SELECT issue_sk, count(*) AS total_test_count FROM links GROUP BY ALL),
            seen AS (SELECT issue_sk, release_name, count(*) FILTER (run_status = 'PASS') AS passing_test_count,
                            count(*) FILTER (run_status = 'FAIL') AS failing_test_count, count(*) FILTER (run_status = 'BLOCKED') AS blocked_test_count,
                            count(*) FILTER (run_status = 'EXECUTING') AS executing_test_count, max(date_sk) AS latest_execution_date_sk
                     FROM links JOIN latest USING (test_sk) GROUP BY ALL),
            planned AS (SELECT c_custkey AS issue_sk, 'R1997Q1' AS release_name FROM customer WHERE c_custkey % 9 = 0),
            merged AS (SELECT issue_sk, release_name, coalesce(passing_test_count, 0) AS passing_test_count, coalesce(failing_test_count, 0) AS failing_test_count,
                            coalesce(blocked_test_count, 0) AS blocked_test_count, coalesce(executing_test_count, 0) AS executing_test_count,
                            latest_execution_date_sk
                     FROM seen FULL JOIN planned USING (issue_sk, release_name))
       SELECT merged.*, coalesce(n.total_test_count, 0) AS total_test_count,
              coalesce(n.total_test_count, 0) - passing_test_count - failing_test_count - blocked_test_count - executing_test_count AS todo_test_count,
              CASE WHEN failing_test_count > 0 THEN 'FAIL' WHEN blocked_test_count > 0 THEN 'BLOCKED' WHEN executing_test_count > 0 THEN 'EXECUTING'
                   WHEN todo_test_count > 0 THEN 'TODO' WHEN passing_test_count > 0 THEN 'PASS' ELSE 'NO_COVERAGE' END AS coverage_status
       FROM merged LEFT JOIN n USING (issue_sk)""",
)(
    lambda i: coverage.from_links(
        requirement_links(i),
        i.t["dim_issue"].where("issue_sk % 9 = 0").select("issue_sk", F.lit(19971).alias("release_sk")),
        spread(i.derived.runs()),
    )
    .join(i.t["dim_release"].select("release_sk", "release_name"), "release_sk")
    .select(
        "issue_sk",
        "release_name",
        *[f"{s}_test_count" for s in ("total", "passing", "failing", "blocked", "executing", "todo")],
        "latest_execution_date_sk",
        "coverage_status",
    )
)

# --- merge shapes -----------------------------------------------------------

SPLIT = "l_shipdate < timestamp_ntz '1998-07-01 00:00:00'"


def deliveries(i, condition):
    """Last delivery per run id among the line items that satisfy a condition."""
    rows = i.raw("lineitem").where(condition).selectExpr(
        "concat(l_orderkey, '-', l_linenumber) AS k",
        "l_shipdate",
        "l_extendedprice AS price",
        "CASE WHEN l_partkey % 3 <> 0 THEN l_returnflag END AS flag",
        "l_suppkey AS supplier",
    )
    return windows.latest(rows, ["k"], ["l_shipdate", "price", "supplier"])


DELIVERED = """rows AS (SELECT l_orderkey || '-' || l_linenumber AS k, l_shipdate, l_extendedprice AS price, l_suppkey AS supplier,
                               CASE WHEN l_partkey % 3 <> 0 THEN l_returnflag END AS flag, l_shipdate < TIMESTAMP '1998-07-01' AS early FROM lineitem),
    last AS (SELECT * FROM rows QUALIFY row_number() OVER (PARTITION BY k, early ORDER BY l_shipdate DESC, price DESC, supplier DESC) = 1),
    t AS (SELECT * FROM last WHERE early), u AS (SELECT * FROM last WHERE NOT early)"""
query(
    "u1_overwrite",
    f"""WITH {DELIVERED} SELECT k, l_shipdate, price, flag, supplier FROM u
        UNION ALL SELECT k, l_shipdate, price, flag, supplier FROM t WHERE k NOT IN (SELECT k FROM u)""",
)(lambda i: upsert.overwrite(deliveries(i, SPLIT), deliveries(i, f"NOT {SPLIT}"), ["k"]))
query(
    "u2_insert_absent",
    f"""WITH {DELIVERED} SELECT k, l_shipdate, price, flag, supplier FROM t
        UNION ALL SELECT k, l_shipdate, price, flag, supplier FROM u WHERE k NOT IN (SELECT k FROM t)""",
)(lambda i: upsert.insert_absent(deliveries(i, SPLIT), deliveries(i, f"NOT {SPLIT}"), ["k"]))
query(
    "u3_patch",
    f"""WITH {DELIVERED} SELECT coalesce(u.k, t.k) AS k, coalesce(u.l_shipdate, t.l_shipdate) AS l_shipdate, coalesce(u.price, t.price) AS price,
               coalesce(u.flag, t.flag) AS flag, coalesce(u.supplier, t.supplier) AS supplier FROM t FULL JOIN u ON u.k = t.k""",
)(lambda i: upsert.patch(deliveries(i, SPLIT), deliveries(i, f"NOT {SPLIT}"), ["k"]))
query(
    "u3_last_known_in_batch",
    """WITH r AS (SELECT s_nationkey, s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_name END AS name,
                         CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS balance FROM supplier)
       SELECT s_nationkey, max_by(name, s_suppkey) FILTER (name IS NOT NULL) AS name,
              max_by(balance, s_suppkey) FILTER (balance IS NOT NULL) AS balance FROM r GROUP BY s_nationkey""",
)(
    lambda i: upsert.last_known(
        i.raw("supplier").selectExpr(
            "s_nationkey",
            "s_suppkey",
            "CASE WHEN s_suppkey % 3 = 0 THEN s_name END AS name",
            "CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS balance",
        ),
        ["s_nationkey"],
        "s_suppkey",
    )
)
query(
    "u4_first_seen_links",
    """SELECT 'D-' || l_orderkey AS defect_key, l_linenumber, l_shipdate, l_suppkey FROM lineitem WHERE l_returnflag = 'R'
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_suppkey) = 1""",
)(
    lambda i: upsert.insert_absent(
        windows.earliest(
            (
                linked := i.raw("lineitem")
                .where("l_returnflag = 'R'")
                .selectExpr("concat('D-', l_orderkey) AS defect_key", "l_linenumber", "l_shipdate", "l_suppkey")
            ).where(SPLIT),
            ["defect_key", "l_linenumber"],
            ["l_shipdate", "l_suppkey"],
        ),
        windows.earliest(linked.where(f"NOT {SPLIT}"), ["defect_key", "l_linenumber"], ["l_shipdate", "l_suppkey"]),
        ["defect_key", "l_linenumber"],
    )
)
query(
    "u5_partial_overwrite",
    f"""WITH {DELIVERED} SELECT coalesce(t.k, u.k) AS k, coalesce(t.l_shipdate, u.l_shipdate) AS l_shipdate, coalesce(t.supplier, u.supplier) AS supplier,
               CASE WHEN u.k IS NOT NULL THEN u.flag ELSE t.flag END AS flag, coalesce(u.price, t.price) AS price
        FROM t FULL JOIN u ON u.k = t.k""",
)(lambda i: upsert.partial(deliveries(i, SPLIT), deliveries(i, f"NOT {SPLIT}"), ["k"], ["flag", "price"]))
query(
    "u6_calendar_names",
    """SELECT date_sk, month_name, day_name FROM dim_date WHERE full_date >= (SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem)
              AND full_date <= (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)""",
)(
    lambda i: calendar.refresh_names(
        (
            days := calendar.from_bounds(
                i.raw("lineitem").agg(F.to_date(F.min("l_shipdate")).alias("a"), F.to_date(F.max("l_shipdate")).alias("b")), "a", "b"
            )
        )
        .where("month <= 6")
        .withColumn("month_name", F.lit("Janvier")),
        days,
    ).select("date_sk", "month_name", "day_name")
)
query(
    "u7_purge_project",
    """SELECT defect_key, status FROM (SELECT CASE WHEN defect_sk % 3 = 0 THEN 'OLD-' ELSE 'D-' END || defect_sk AS defect_key, status FROM dim_defect)
       WHERE defect_key NOT LIKE 'OLD-%'""",
)(
    lambda i: upsert.purge_project(
        i.t["dim_defect"].selectExpr("concat(CASE WHEN defect_sk % 3 = 0 THEN 'OLD-' ELSE 'D-' END, defect_sk) AS defect_key", "status"),
        "defect_key",
        "OLD",
    )
)
query(
    "q17_change_counts",
    f"WITH {DELIVERED} SELECT count(*) FILTER (t.k IS NULL) AS inserted, count(t.k) AS updated FROM u LEFT JOIN t ON t.k = u.k",
)(lambda i: upsert.changes(deliveries(i, SPLIT), deliveries(i, f"NOT {SPLIT}"), ["k"]))
query(
    "j1_surrogate_keys_are_dense",
    "SELECT count(*) AS n, count(*) AS distinct_keys, 101 AS lowest, 100 + count(*) AS highest FROM part",
)(
    lambda i: keys.number(i.t["dim_test"].select("test_key"), "test_key", "sk", 100).agg(
        F.count("*").alias("n"),
        F.count_distinct("sk").alias("distinct_keys"),
        F.min("sk").alias("lowest"),
        F.max("sk").alias("highest"),
    )
)


def replay(i, batches):
    """Last-writer state after merging the line items batch by batch, as delta loads would."""
    edges = [f"l_shipdate < timestamp_ntz '{year}-01-01 00:00:00'" for year in batches]
    cuts = [edges[0], *(f"NOT {a} AND {b}" for a, b in zip(edges, edges[1:], strict=False)), f"NOT coalesce({edges[-1]}, false)"]
    state = deliveries(i, cuts[0])
    for condition in cuts[1:]:
        state = upsert.overwrite(state, deliveries(i, condition), ["k"])
    return state


query(
    "i4_replayed_deltas_equal_full_load",
    """SELECT l_orderkey || '-' || l_linenumber AS k, l_shipdate, l_extendedprice AS price, l_suppkey AS supplier,
              CASE WHEN l_partkey % 3 <> 0 THEN l_returnflag END AS flag FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC, l_suppkey DESC) = 1""",
)(lambda i: replay(i, [1997, 1999]))


def streamed_executions(i):
    """Executions staged as files, applied by the streaming delta load, read back as a published table."""
    root = f"{shared_folder(i.spark)}/stream-{uuid.uuid4().hex}"
    staging.write(P.executions(i), f"{root}/staging")
    warehouse = Warehouse(i.spark, f"{root}/warehouse")
    delta.start(i.spark, f"{root}/staging", warehouse.root, f"{root}/checkpoint", date(2024, 3, 1)).awaitTermination()
    return warehouse.star()["dim_test_execution"].drop("execution_sk", "assignee")


query("i1_streamed_delta_load", EXECUTION)(streamed_executions)
query(
    "j8_join_on_computed_day",
    """SELECT d.year, d.week_of_year, d.is_weekend, count(*) AS defects FROM dim_defect x
       JOIN dim_date d ON d.full_date = CAST(x.created_at AS DATE) GROUP BY ALL""",
)(
    lambda i: i.t["dim_defect"]
    .withColumn("date_sk", X.date_to_sk(F.to_date("created_at")))
    .join(i.t["dim_date"], "date_sk")
    .groupBy("year", "week_of_year", "is_weekend")
    .agg(F.count("*").alias("defects"))
)


# --- keys without case, compaction, rejects, history ---------------------------------


def mixed_case_keys(i):
    """Squads named by orders in three spellings, half of them known before; one row and one key each."""
    spelled = "CASE o_orderkey % 3 WHEN 0 THEN upper(name) WHEN 1 THEN lower(name) ELSE initcap(name) END"
    rows = i.raw("orders").selectExpr("o_orderkey", "concat('squad ', o_orderpriority, ' ', o_custkey % 40) AS name").selectExpr(f"{spelled} AS squad_name", "o_orderkey AS ord")
    early, late = rows.where("ord % 2 = 0"), rows.where("ord % 2 = 1")
    layout = i.spark.createDataFrame([], "squad_sk BIGINT, squad_name STRING, program_sk BIGINT")
    state = layout
    for batch in (early, late):
        named = keys.respelled(batch, "squad_name", F.col("ord"), state)
        updates = windows.latest(named, ["squad_name"], ["ord"]).select("squad_name", F.col("ord").alias("program_sk"))
        state = cut(keys.merge_dimension(state, updates, "squad_name", "squad_sk", upsert.overwrite))
    return state.select("squad_name", "program_sk", (F.col("squad_sk") > 0).alias("has_key"))


query(
    "j1_keys_without_case",
    """WITH r AS (SELECT o_orderkey, 'squad ' || o_orderpriority || ' ' || (o_custkey % 40) AS name FROM orders),
            s AS (SELECT o_orderkey, lower(name) AS folded, CASE o_orderkey % 3 WHEN 0 THEN upper(name) WHEN 1 THEN lower(name)
                         ELSE 'Squad ' || replace(lower(name[7:]), ' specified', ' Specified') END AS spelled, o_orderkey % 2 AS late FROM r)
       SELECT arg_min(spelled, (late, o_orderkey)) AS squad_name, arg_max(o_orderkey, (late, o_orderkey)) AS program_sk, true AS has_key FROM s GROUP BY folded""",
)(mixed_case_keys)


def compacted_staging(i):
    """Executions staged twice, in many files, and compacted; what a scan gives, and how many records are left of each."""
    root = f"{shared_folder(i.spark)}/staging-{uuid.uuid4().hex}"
    records = P.executions(i)
    newer = records.withColumns({"loaded_at": F.expr("loaded_at + interval 1 hour"), "raw_json": F.replace("raw_json", F.lit('"summary":"'), F.lit('"summary":"new '))})
    staging.write(records.repartition(6), root)
    staging.write(newer.where("source_key LIKE '%3'").repartition(4), root)
    staging.compact(i.spark, root, date(2024, 3, 2))
    staging.sweep(i.spark, root)
    left = i.spark.read.schema(staging.LAYOUT).parquet(root).groupBy("source_key").agg(F.count(F.lit(1)).alias("n_records"))
    found = staging.scan(i.spark, root).select("source_key", F.get_json_object("raw_json", "$.fields.summary").alias("summary"))
    return found.join(left, "source_key")


query(
    "s9_compacted_staging",
    """SELECT 'E-' || o_orderkey AS source_key, CASE WHEN o_orderkey % 10 = 3 THEN 'new ' ELSE '' END || o_orderpriority AS summary, 1 AS n_records FROM orders""",
)(compacted_staging)
CHECKED = FieldMap(
    [
        FieldMapping("customfield_10204", "severity", "dim_defect", "severity", "jira_defect", "issue_key"),
        FieldMapping("customfield_10203", "root_cause", "dim_root_cause", "root_cause_name", "jira_defect", "select_value"),
        FieldMapping("customfield_10010", "label", "dim_defect", "priority", "jira_defect", "number"),
    ]
)


def defect_payloads(i):
    """The mapped part of the defects' payloads, under ``v`` as the map finds it."""
    return staging.parse(P.defects(i)).select("source_key", X.node(V, "$.fields").alias("v"))


query(
    "c12_mapped_fields",
    """SELECT 'D-' || o_orderkey AS source_key, 'root_cause' AS logical_name, 'Application Bug' AS value FROM orders WHERE o_orderkey % 5 <> 0""",
)(lambda i: CHECKED.coercions("jira_defect", defect_payloads(i)).where("reason IS NULL").select("source_key", "logical_name", "value"))
query(
    "d16_coercion_rejects",
    """SELECT 'D-' || o_orderkey AS source_key, 'severity' AS logical_name, CAST(NULL AS VARCHAR) AS value, 'missing_member' AS reason FROM orders WHERE o_orderkey % 4 <> 0
       UNION ALL SELECT 'D-' || o_orderkey, 'label', 'Low', 'unknown_field_type' FROM orders WHERE o_orderkey % 8 <> 0""",
)(lambda i: CHECKED.coercions("jira_defect", defect_payloads(i)).where("reason IS NOT NULL"))


def cut_off_pages(i):
    """Defect pages of which every third was cut off."""
    number = F.regexp_extract("origin", "([0-9]+)/page", 1).cast("bigint")
    pages = P.pages(i.raw("orders"), "concat('B', o_orderkey div 100)", P.DEFECT, "named_struct('issues', @)")
    return pages.withColumn("body", F.when(number % 3 == 0, F.substring("body", 1, 40)).otherwise(F.col("body")))


query(
    "d16_bad_pages",
    """SELECT DISTINCT 'landing/B' || (o_orderkey // 100) || '/page.json' AS source, 'bad_json' AS reason, 40 AS length FROM orders WHERE (o_orderkey // 100) % 3 = 0""",
)(lambda i: landing.bad_pages(cut_off_pages(i)).select("source", "reason", F.length("body").alias("length")))


def former_types(i):
    """Tests staged three times with changing types, and the runs that saw another type than the last."""
    root = f"{shared_folder(i.spark)}/staging-{uuid.uuid4().hex}"
    number = F.substring_index("source_key", "-", -1).cast("bigint")
    kind = lambda c, old, new: F.replace(F.replace(c, F.lit(f'"name":"{old}"'), F.lit(f'"name":"{new}"')), F.lit(f'"value":"{old}"'), F.lit(f'"value":"{new}"'))
    first = P.tests(i)
    second = first.withColumn("raw_json", F.when(number % 3 == 0, kind(F.col("raw_json"), "Manual", "Generic")).otherwise(F.col("raw_json")))
    third = second.withColumn("raw_json", F.when(number % 2 == 0, kind(F.col("raw_json"), "Generic", "Manual")).otherwise(F.col("raw_json")))
    for n, (records, year) in enumerate(((first, 1994), (second, 1996), (third, 1998))):
        dated = records.withColumns({"loaded_at": F.expr(f"timestamp '{year}-01-01 00:00:00'"), "run_id": F.lit(f"run-{n}")})
        staging.write(dated, root)
    tests = dims.tests(staging.parse(staging.scan(i.spark, root, "xray_test")), MAP)
    history = tests.select("test_key", "test_type_name", F.col("ord.loaded_at").cast("timestamp_ntz").alias("loaded_at"), "ord")
    runs = facts.runs_of(P.runs(i, rule("run_id")), "test_key", "test_run_id", "started_at")
    return quality.runs_of_former_types(runs, quality.type_versions(history))


query(
    "d15_runs_of_former_types",
    """WITH t0 AS (SELECT test_key, test_sk AS p, test_type_name AS a FROM dim_test),
            t1 AS (SELECT *, CASE WHEN p % 3 = 0 AND a = 'Manual' THEN 'Generic' ELSE a END AS b FROM t0),
            t2 AS (SELECT *, CASE WHEN p % 2 = 0 AND b = 'Generic' THEN 'Manual' ELSE b END AS c FROM t1),
            r AS (SELECT l_partkey, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS test_run_id,
                         l_shipdate::DATE::TIMESTAMP + INTERVAL 1410 MINUTE + CASE WHEN l_suppkey % 2 = 0 THEN INTERVAL 5 HOUR ELSE INTERVAL 0 HOUR END AS ts FROM lineitem)
       SELECT test_run_id, test_key, CASE WHEN ts < TIMESTAMP '1996-01-01' THEN a WHEN ts < TIMESTAMP '1998-01-01' THEN b ELSE c END AS seen_type, c AS current_type
       FROM r JOIN t2 ON p = l_partkey WHERE seen_type IS DISTINCT FROM c""",
)(former_types)


def map_file(i):
    """A map file with a field per nation; nations of some regions have a field type nobody knows."""
    root = f"{shared_folder(i.spark)}/map-{uuid.uuid4().hex}"
    kind = "CASE n_regionkey WHEN 0 THEN 'string' WHEN 1 THEN 'array' WHEN 2 THEN 'number' WHEN 3 THEN NULL ELSE 'date' END"
    fields = f"""named_struct('source_field_id', concat('customfield_', n_nationkey), 'logical_name', lower(n_name), 'target_table', 'dim_issue',
                              'target_column', 'business_area', 'entity_type', 'jira_issue', 'field_type', {kind})"""
    doc = i.raw("nation").agg(F.expr(f"to_json(named_struct('mappings', collect_list({fields})))").alias("value"))
    doc.write.text(root)
    return FieldMap.load(i.spark, root)


query(
    "s6_field_map_file",
    """SELECT 'customfield_' || n_nationkey AS source_field_id, lower(n_name) AS logical_name,
              CASE n_regionkey WHEN 0 THEN 'string' WHEN 1 THEN 'array' WHEN 2 THEN 'number' WHEN 3 THEN 'string' ELSE 'date' END AS field_type FROM nation""",
)(
    lambda i: i.spark.createDataFrame(
        [(m.source_field_id, m.logical_name, m.field_type) for m in map_file(i).mappings_for("jira_issue")], "source_field_id STRING, logical_name STRING, field_type STRING"
    )
)
query(
    "c12f_unknown_field_types",
    "SELECT lower(n_name) AS logical_name, CASE n_regionkey WHEN 2 THEN 'number' ELSE 'date' END AS field_type FROM nation WHERE n_regionkey IN (2, 4)",
)(lambda i: map_file(i).unknown_types(i.spark).select("logical_name", "field_type"))
