"""JSON payloads made from the test tables, for the parsing operators and builders.

The payloads vary in shape the way the trackers' do: objects or scalars, missing fields, offsets.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualitymart.queries.registry import Inputs
from qualitymart.session import spread
from qualitymart.sources import staging
from qualitymart.sources.derived import rule

LOADED = datetime(2024, 3, 1, tzinfo=timezone.utc)
ISO = "date_format({0}, \"yyyy-MM-dd'T'HH:mm:ss\")"


def records(rows: DataFrame, entity: str, key: str, payload: str) -> DataFrame:
    return rows.selectExpr(
        "'run-1' AS run_id",
        f"{key} AS source_key",
        f"'{entity}' AS entity_type",
        f"{payload} AS raw_json",
        "timestamp '2024-03-01 00:00:00' AS loaded_at",
    )


def parsed(rows: DataFrame) -> DataFrame:
    return staging.parse(rows)


ISSUE = """named_struct(
    'key', concat('REQ-', c_custkey),
    'fields', named_struct(
        'summary', c_name,
        'issuetype', named_struct('name', 'Story'),
        'status', named_struct('name', CASE WHEN c_custkey % 3 = 0 THEN 'Done' ELSE 'In Progress' END),
        'priority', CASE WHEN c_custkey % 4 <> 0 THEN named_struct('name', CASE WHEN c_acctbal > 8000 THEN 'P1' ELSE 'Medium' END) END,
        'reporter', named_struct('displayName', CASE WHEN c_custkey % 5 <> 0 THEN concat('user', c_custkey % 50) END,
                                 'accountId', concat('acc', c_custkey % 50)),
        'assignee', CASE WHEN c_custkey % 7 <> 0 THEN named_struct('displayName', concat('dev', c_custkey % 20)) END,
        'issuelinks', CASE WHEN c_custkey % 6 <> 0 THEN array(
            named_struct('outwardIssue', named_struct('key', concat('T-', c_custkey % 200 + 1)), 'inwardIssue', NULL),
            named_struct('outwardIssue', NULL, 'inwardIssue', named_struct('key', concat('T-', c_custkey % 150 + 1)))) END,
        'created', '2024-01-09T06:40:00.000+0000',
        'updated', concat('2024-02-', lpad(cast(c_custkey % 28 + 1 as string), 2, '0'), 'T10:30:15.000+0000'),
        'customfield_10200', r_name,
        'customfield_10201', concat('NATION_', (c_custkey % 6) * 4),
        'customfield_10202', CASE WHEN c_custkey % 10 = 0 THEN '2024-01-01' WHEN c_custkey % 3 <> 0 THEN concat('App ', c_mktsegment) END,
        'customfield_10205', c_mktsegment,
        'components', array(named_struct('name', 'Core'), named_struct('name', 'Other')),
        'fixVersions', array(named_struct('name', concat('v', c_custkey % 7)))))"""


def customers(i: Inputs) -> DataFrame:
    """Customers with their region's name."""
    return (
        i.raw("customer")
        .join(i.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(i.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )


def issues(i: Inputs) -> DataFrame:
    return records(spread(customers(i)), "jira_issue", "concat('REQ-', c_custkey)", f"to_json({ISSUE})")


DEFECT = f"""named_struct(
    'key', concat('D-', o_orderkey),
    'fields', named_struct(
        'summary', concat('Defect of order ', o_orderkey),
        'issuetype', named_struct('name', CASE WHEN o_orderkey % 2 = 0 THEN 'Bug' ELSE 'Defect' END),
        'status', named_struct('name', {rule('defect_status')}),
        'priority', named_struct('name', CASE WHEN o_orderkey % 9 = 0 THEN 'P0' ELSE o_orderpriority END),
        'assignee', CASE WHEN o_orderkey % 7 <> 0 THEN named_struct('accountId', concat('acc', o_orderkey % 100)) END,
        'customfield_10204', CASE WHEN o_orderkey % 4 <> 0 THEN named_struct('value', {rule('severity')}) END,
        'customfield_10010', CASE WHEN o_orderkey % 8 <> 0 THEN 'Low' END,
        'customfield_10203', CASE WHEN o_orderkey % 5 <> 0 THEN named_struct('value', 'Application Bug') END,
        'components', CASE WHEN o_orderkey % 3 = 0 THEN array(concat('Brand#', o_orderkey % 25 + 1)) END,
        'created', concat({ISO.format('o_orderdate')}, '+05:30'),
        'updated', concat({ISO.format('o_orderdate')}, '.000+0000'),
        'resolutiondate', CASE WHEN o_orderstatus = 'F' THEN concat({ISO.format('o_orderdate')}, 'Z') END))"""


def defects(i: Inputs) -> DataFrame:
    return records(spread(i.raw("orders")), "jira_defect", "concat('D-', o_orderkey)", f"to_json({DEFECT})")


SERVER_TEST = f"""to_json(named_struct(
    'key', concat('T-', p_partkey),
    'fields', named_struct(
        'summary', p_name, 'status', named_struct('name', 'Active'), 'squad_name', concat('NATION_', (p_partkey % 6) * 4),
        'assignee', CASE WHEN p_size % 3 <> 0 THEN concat('owner', p_size % 3) END, 'created', '2024-01-11T13:05:00.000+0000',
        'customfield_10100', named_struct('value', {rule('test_type')}),
        'customfield_10101', concat('/repo/', p_brand), 'customfield_10104', CASE WHEN p_size > 25 THEN 'run it' END)))"""
CLOUD_TEST = f"""to_json(named_struct(
    'issueId', cast(p_partkey + 100000 as string), 'testType', named_struct('name', {rule('test_type')}),
    'gherkin', CASE WHEN p_size <= 25 THEN concat('Scenario ', p_size) ELSE '' END, 'unstructured', 'free text',
    'jira', named_struct('key', concat('T-', p_partkey), 'summary', p_name, 'status', 'Active', 'customfield_10101', '')))"""


def tests(i: Inputs) -> DataFrame:
    """Every other test comes from the cloud variant."""
    payload = f"CASE WHEN p_partkey % 2 = 0 THEN {SERVER_TEST} ELSE {CLOUD_TEST} END"
    return records(spread(i.raw("part")), "xray_test", "concat('T-', p_partkey)", payload)


def executions(i: Inputs) -> DataFrame:
    payload = """to_json(named_struct(
        'key', concat('E-', o_orderkey),
        'fields', named_struct(
            'summary', o_orderpriority, 'status', named_struct('name', o_orderstatus),
            'customfield_10300', CASE WHEN o_orderkey % 6 <> 0
                THEN array(named_struct('value', element_at(array('DEV', 'SIT', 'UAT'), cast(o_orderkey % 3 + 1 as int))),
                           named_struct('value', 'PROD')) END,
            'customfield_10301', named_struct('key', concat('P-', o_orderkey % 11)),
            'customfield_10302', concat('rev-', o_orderkey % 10),
            'updated', concat(cast(cast(o_orderdate as date) as string), 'T08:00:00-02:00'))))"""
    return records(spread(i.raw("orders")), "xray_test_execution", "concat('E-', o_orderkey)", payload)


RUN = f"""named_struct(
    'id', concat(l_orderkey, '-', l_linenumber),
    'status', named_struct('name', {rule('run_status')}),
    'startedOn', concat(cast(cast(l_shipdate as date) as string), 'T23:30:00', CASE WHEN l_suppkey % 2 = 0 THEN '-05:00' ELSE 'Z' END),
    'finishedOn', CASE WHEN l_linestatus = 'F' THEN concat(cast(cast(l_shipdate as date) as string), 'T23:45:00',
                       CASE WHEN l_suppkey % 2 = 0 THEN '-05:00' ELSE 'Z' END) END,
    'assignee', CASE WHEN l_suppkey % 3 <> 0 THEN named_struct('accountId', concat('acc', l_suppkey), 'displayName',
                     concat('Supplier ', l_suppkey)) END,
    'comment', concat(l_returnflag, l_linestatus),
    'defects', CASE WHEN l_returnflag = 'R' THEN array(named_struct('key', concat('D-', l_orderkey), 'jira',
                    CASE WHEN l_linenumber = 1 THEN named_struct('key', concat('D-', l_orderkey + 1), 'status',
                         named_struct('name', CASE WHEN l_suppkey % 2 = 0 THEN 'Closed' ELSE 'Open' END)) END)) END,
    'steps', transform(sequence(1, l_linenumber % 3 + 1), n -> named_struct('id', concat('s', n), 'index', n,
                       'status', named_struct('name', 'PASS'), 'actualResult', concat('result ', n))),
    'test', named_struct('key', concat('T-', l_partkey), 'testType', named_struct('name',
                         CASE WHEN l_partkey % 3 = 0 THEN 'Manual' ELSE 'Generic' END)),
    'customFields', array(named_struct('name', 'Root_Cause', 'value', CASE WHEN l_returnflag = 'R' THEN 'Application Bug' END)),
    'fixVersions', CASE WHEN l_linenumber = 2 THEN array('v1', 'v2') WHEN l_linenumber <> 3 THEN array('v3') END)"""


def run_rows(i: Inputs) -> DataFrame:
    return spread(i.raw("lineitem"))


def runs(i: Inputs, key: str = "concat(l_orderkey, '-', l_linenumber)") -> DataFrame:
    """One record per line item; by default run ids repeat, ``rule('run_id')`` makes them unique."""
    with_key = f"""concat('{{"_execution_key":"E-', l_orderkey, '",', substring(to_json({RUN}), 2))"""
    return records(run_rows(i).withColumn("_key", F.expr(key)), "xray_test_run", "_key", with_key)


def pages(rows: DataFrame, page: str, item: str, envelope: str) -> DataFrame:
    """Pages (body, origin) of at most a hundred items; ``envelope`` holds ``@`` for the item list.

    Rows are dealt out by page before items are made of them, so the shuffle carries the rows.
    """
    items = f"collect_list({item})"
    body = F.expr(f"to_json({envelope.replace('@', items)})")
    return spread(rows.withColumn("_page", F.expr(page)), "_page").groupBy("_page").agg(body.alias("body")).select(
        "body", F.concat(F.lit("landing/"), F.col("_page").cast("string"), F.lit("/page.json")).alias("origin")
    )
