"""Compare registered queries with their DuckDB counterparts."""

from __future__ import annotations

import sys
import tempfile
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def normal(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, int):
        return float(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float) and value != value:
        return None
    return value


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return Counter(tuple(normal(row[k]) for k in order) for row in values)


def check(name, spark, con, sf_dir):
    """(ok, message) for one query."""
    from qualitymart.queries import ORACLES, QUERIES

    start = time.time()
    frame = QUERIES[name](spark, sf_dir)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    pairs = [op for op in ("CartesianProduct", "BroadcastNestedLoopJoin") if op in plan]
    got = frame.collect()
    seconds = time.time() - start
    if pairs:
        return False, f"{name}: plan has {pairs}"
    if name not in ORACLES:
        return True, f"{name}: {len(got)} rows, no SQL ({seconds:.1f} s)"
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(frame.columns) != sorted(names):
        return False, f"{name}: columns {sorted(frame.columns)} != {sorted(names)}"
    left, right = rows(frame.columns, got), rows(names, expected)
    if left == right:
        return True, f"{name}: {len(got)} rows equal ({seconds:.1f} s)"
    extra, missing = list((left - right).items()), list((right - left).items())
    return False, f"{name}: {len(got)} vs {len(expected)} rows\n  columns {sorted(names)}\n  only spark {extra[:3]}\n  only sql   {missing[:3]}"


if __name__ == "__main__":
    from qualitymart.queries import QUERIES
    from qualitymart.session import local_session

    sf = f"/root/testdata/sf{sys.argv[1]}"
    parts = [part for part in sys.argv[2:] if not part.startswith("cpus=")]
    cpus = next((part[5:] for part in sys.argv[2:] if part.startswith("cpus=")), "8")
    session = local_session(cpus, folder=tempfile.mkdtemp(prefix="compare-"))
    session.sparkContext.setLogLevel("ERROR")
    connection = duck(sf)
    chosen = [q for q in QUERIES if not parts or any(part in q for part in parts)]
    bad = []
    for q in chosen:
        try:
            ok, message = check(q, session, connection, sf)
        except Exception as error:  # noqa: BLE001
            ok, message = False, f"{q}: {type(error).__name__} {str(error)[:1500]}"
        print("ok  " if ok else "BAD ", message, flush=True)
        if not ok:
            bad.append(q)
    print(f"{len(chosen) - len(bad)}/{len(chosen)} ok; bad: {bad}")
