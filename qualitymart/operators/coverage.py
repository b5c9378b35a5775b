"""Requirement coverage per (requirement, release)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The status that describes a requirement, by falling priority.
STATUS_PRIORITY = ("FAIL", "BLOCKED", "EXECUTING", "TODO", "PASS")

_PAIR = ["issue_sk", "release_sk"]


def _test_status(run_status: Column) -> Column:
    """ABORTED, unknown and missing results still have to be run."""
    return F.when(run_status.isin("PASS", "FAIL", "BLOCKED", "EXECUTING"), run_status).otherwise("TODO")


def _status_code(run_status: Column) -> Column:
    """The place of the test's status in ``STATUS_PRIORITY``, in one byte."""
    return F.array_position(F.array(*[F.lit(c) for c in STATUS_PRIORITY]), _test_status(run_status)).cast("tinyint")


def latest_per_test(runs: DataFrame, keys: Sequence[str], extra_order: Sequence[str] = ()) -> DataFrame:
    """Status and date of the latest run per key; an aggregate, so a hot test is combined map-side."""
    order = F.struct("started_at", "test_run_id", *extra_order)
    return runs.groupBy(*keys).agg(F.max_by(F.struct("run_status", "date_sk"), order).alias("_last")).select(
        *keys, "_last.*"
    )


def _finish(counted: DataFrame) -> DataFrame:
    total, passing = F.col("total_test_count"), F.col("passing_test_count")
    counts = dict(
        zip(
            STATUS_PRIORITY,
            ("failing_test_count", "blocked_test_count", "executing_test_count", "todo_test_count", "passing_test_count"),
        )
    )
    status = F.lit("NO_COVERAGE")
    for name in reversed(STATUS_PRIORITY):
        status = F.when(F.col(counts[name]) > 0, name).otherwise(status)
    return counted.select(
        "*",
        (total == 0).cast("int").alias("no_coverage_count"),
        status.alias("coverage_status"),
        ((passing > 0) & (passing < total)).alias("partial_coverage_flag"),
        (F.col("failing_test_count") > 0).alias("failed_coverage_flag"),
        (passing > 0).alias("is_covered"),
    )


def _count(status: str) -> Column:
    return F.count_if(F.col("_status") == status)


def from_runs(runs: DataFrame, extra_order: Sequence[str] = ()) -> DataFrame:
    """Coverage where each run already names its requirement."""
    latest = latest_per_test(runs, [*_PAIR, "test_sk"], extra_order).withColumn("_status", _test_status(F.col("run_status")))
    return _finish(
        latest.groupBy(*_PAIR).agg(
            F.count("*").alias("total_test_count"),
            _count("PASS").alias("passing_test_count"),
            _count("FAIL").alias("failing_test_count"),
            _count("BLOCKED").alias("blocked_test_count"),
            _count("EXECUTING").alias("executing_test_count"),
            _count("TODO").alias("todo_test_count"),
            F.max("date_sk").alias("latest_execution_date_sk"),
        )
    )


def from_links(links: DataFrame, planned: DataFrame, runs: DataFrame) -> DataFrame:
    """Coverage through requirement-to-test links.

    ``links``: (issue_sk, test_sk); ``planned``: (issue_sk, release_sk) from the requirement's own
    fix versions; ``runs``: run facts. Runs are cut down to one row per (test, release) before they
    meet the links, so the join grows with links times releases, never with the number of runs.
    """
    return from_latest(links, planned, latest_per_test(runs.where("test_sk IS NOT NULL"), ["test_sk", "release_sk"]))


def from_latest(links: DataFrame, planned: DataFrame, latest: DataFrame) -> DataFrame:
    """As ``from_links``, for the last run of each (test, release): ``test_sk, release_sk, run_status, date_sk``."""
    links = links.select("issue_sk", "test_sk").distinct()
    linked_tests = links.groupBy("issue_sk").agg(F.count("*").alias("total_test_count"))
    # A test's releases go as lists to the requirements linked to it and are taken apart there: what is shuffled grows
    # with the links, where every link times release would have been a row of its own.
    state = F.struct("release_sk", _status_code(F.col("run_status")).alias("_code"), "date_sk")
    states = latest.groupBy("test_sk").agg(F.collect_list(state).alias("_states"))
    listed = states.select("test_sk", *[F.col(f"_states.{c}").alias(c) for c in ("release_sk", "_code", "date_sk")])
    seen = (
        links.join(listed, "test_sk")
        .select("issue_sk", "release_sk", "_code", "date_sk")
        .repartition("issue_sk")
        .select("issue_sk", F.inline(F.arrays_zip("release_sk", "_code", "date_sk")))
        .withColumn("_status", F.element_at(F.array(*[F.lit(c) for c in STATUS_PRIORITY]), F.col("_code").cast("int")))
        .groupBy(*_PAIR)
        .agg(
            F.count("*").alias("_seen"),
            _count("PASS").alias("passing_test_count"),
            _count("FAIL").alias("failing_test_count"),
            _count("BLOCKED").alias("blocked_test_count"),
            _count("EXECUTING").alias("executing_test_count"),
            _count("TODO").alias("_todo"),
            F.max("date_sk").alias("latest_execution_date_sk"),
        )
    )
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("bigint")
    counted = (
        seen.join(planned.select(*_PAIR).distinct(), _PAIR, "full")
        .join(linked_tests, "issue_sk", "left")
        .select(
            *_PAIR,
            zero("total_test_count").alias("total_test_count"),
            zero("passing_test_count").alias("passing_test_count"),
            zero("failing_test_count").alias("failing_test_count"),
            zero("blocked_test_count").alias("blocked_test_count"),
            zero("executing_test_count").alias("executing_test_count"),
            (zero("_todo") + zero("total_test_count") - zero("_seen")).alias("todo_test_count"),
            "latest_execution_date_sk",
        )
    )
    return _finish(counted)
