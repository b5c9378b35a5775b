"""A small set of payloads with known results."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

DAY = datetime(2024, 3, 2, tzinfo=timezone.utc)


def issue(key="SHOP-10", squad="Team Oak", updated="2024-03-01T16:20:00.000+0000", links=("SHOP-703", "SHOP-710"), **fields):
    return {
        "key": key,
        "fields": {
            "summary": "Basket survives a reload",
            "issuetype": {"name": "Story"},
            "status": {"name": "In Progress"},
            "priority": {"name": "High"},
            "assignee": {"displayName": "Mira Voss", "accountId": "u-71"},
            "reporter": {"displayName": "Jon Ebel", "accountId": "u-18"},
            "created": "2024-01-09T06:40:00.000+0000",
            "updated": updated,
            "resolutiondate": None,
            "customfield_10200": "Storefront",
            "customfield_10201": squad,
            "components": [{"name": "Basket"}, {"name": "Prices"}],
            "fixVersions": [{"name": "w7.3"}],
            "issuelinks": [{"outwardIssue": {"key": k}} for k in links],
            **fields,
        },
    }


def defect(key="SHOP-66", status="Open", severity="Critical"):
    return {
        "key": key,
        "fields": {
            "summary": "Total is wrong",
            "issuetype": {"name": "Bug"},
            "status": {"name": status},
            "priority": {"name": "P1"},
            "customfield_10204": {"value": severity},
            "customfield_10203": {"value": "Application Bug"},
            "created": "2024-02-06T21:30:00Z",
            "resolutiondate": None,
        },
    }


def test_case(key="SHOP-703", kind="Manual", squad="Team Oak"):
    return {
        "key": key,
        "fields": {
            "summary": "Add two items to the basket",
            "status": {"name": "Active"},
            "squad_name": squad,
            "created": "2024-01-11T13:05:00.000+0000",
            "customfield_10100": {"value": kind},
            "customfield_10101": "/shop/basket",
        },
    }


def execution(key="SHOP-1403"):
    return {
        "key": key,
        "fields": {
            "summary": "Spring round",
            "status": "Open",
            "customfield_10300": [{"value": "SIT"}, "UAT"],
            "customfield_10301": {"key": "SHOP-2103"},
            "customfield_10302": "r1",
        },
    }


def plan(key="SHOP-2103"):
    return {"issueId": "300", "jira": {"key": key, "summary": "Plan", "status": {"name": "Open"}, "customfield_10201": "Team Oak"}}


def run(run_id="5107", test="SHOP-703", status="PASS", versions=("w7.3",), started="2024-03-01T07:15:00Z", defects=(), **more):
    return {
        "id": run_id,
        "status": {"name": status},
        "startedOn": started,
        "finishedOn": "2024-03-01T07:20:30Z",
        "assignee": {"displayName": "Mira Voss"},
        "comment": "as planned",
        "defects": list(defects),
        "test": {"key": test, "testType": {"name": "Manual"}},
        "_execution_key": "SHOP-1403",
        "fixVersions": list(versions),
        **more,
    }


def step(run_id="5107", name="s1", status="PASS", index=1):
    return {"id": name, "index": index, "status": {"name": status}, "actualResult": "OK", "comment": "", "_test_run_id": run_id}


def version(name="w7.3", **more):
    return {"id": "1", "name": name, "description": "wave 4", "releaseDate": "2024-04-01", "released": False, **more}


def record(entity, key, payload, hours=0, run_id="run-1"):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    return (run_id, key, entity, text, DAY + timedelta(hours=hours))


def batches():
    """Three deliveries; later ones change what earlier ones brought."""
    first = [
        record("jira_version", "1", version()),
        record("jira_issue", "SHOP-10", issue()),
        record("jira_defect", "SHOP-66", defect()),
        record("xray_test", "SHOP-703", test_case()),
        record("xray_test", "SHOP-710", test_case("SHOP-710", "Generic")),
        record("xray_test_plan", "SHOP-2103", plan()),
        record("xray_test_execution", "SHOP-1403", execution()),
        record("xray_test_run", "5107", run(versions=("w7.3", "w7.4"), status="FAIL", defects=[{"key": "SHOP-66"}, "SHOP-542"])),
        record("xray_test_step_result", "5107:s1", step()),
        record("jira_issue", "BAD", "<html>busy</html>"),
    ]
    second = [
        record("xray_test_run", "5108", run("5108", "SHOP-710", "PASS", started="2024-03-01T08:15:00+05:30"), 1, "run-2"),
        record("xray_test_run", "5109", run("5109", "SHOP-703", "ON HOLD", versions=(), started=None), 1, "run-2"),
        record("xray_test_step_result", "5107:s1", {**step(status="FAIL", index=7), "_test_run_id": "other"}, 1, "run-2"),
        record("jira_version", "1", version(released=True, releaseDate="2024-05-01", description=None), 1, "run-2"),
    ]
    third = [
        record("xray_test_run", "5107", run(status="PASS", defects=[{"key": "SHOP-66", "jira": {"key": "SHOP-66", "status": {"name": "Done"}}}]), 2, "run-3"),
        record("jira_issue", "SHOP-10", issue(summary="Changed", priority={"name": "P0"}), 2, "run-3"),
        record("jira_issue", "SHOP-17", issue("SHOP-17", "Team Pine", links=()), 2, "run-3"),
        record("jira_defect", "SHOP-66", defect(status="Closed"), 2, "run-3"),
    ]
    return [first, second, third]
