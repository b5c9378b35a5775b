"""Registered queries and, where SQL can express them, their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from qualitymart.queries import oracle
from qualitymart.session import configure
from qualitymart.sources.derived import DerivedStar

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
RAW_SQL: dict[str, str] = {}
_BUILDS: dict[str, Callable] = {}


class Inputs:
    """What a registered query gets: the derived star ``t``, the raw tables and the session."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.derived = DerivedStar(spark, sf_dir)
        self.t = self.derived.star()
        self.raw = self.derived.raw


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` may use the star tables named in ``oracle.STAR``."""

    def register(build: Callable[[Inputs], DataFrame]):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Inputs(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        _BUILDS[name] = build
        if sql is not None:
            RAW_SQL[name] = sql
            ORACLES[name] = oracle.with_star(sql)
        return build

    return register


def build(name: str, inputs: Inputs) -> DataFrame:
    """A registered query over inputs that are already there."""
    return _BUILDS[name](inputs)
