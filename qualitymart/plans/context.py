"""Filter context and joins of facts to their dimensions."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualitymart.sources.star import Star

# Many-to-one edges of the model as (table, column, dimension, key, active).
# An inactive edge takes no part in filtering unless a query asks for it.
RELATIONSHIPS = (
    ("fact_test_run", "release_sk", "dim_release", "release_sk", True),
    ("fact_test_run", "test_sk", "dim_test", "test_sk", True),
    ("fact_test_run", "execution_sk", "dim_test_execution", "execution_sk", True),
    ("fact_test_run", "environment_sk", "dim_environment", "environment_sk", True),
    ("fact_test_run", "tester_sk", "dim_tester", "tester_sk", True),
    ("fact_test_run", "status_sk", "dim_status", "status_sk", True),
    ("fact_test_run", "root_cause_sk", "dim_root_cause", "root_cause_sk", True),
    ("fact_test_run", "date_sk", "dim_date", "date_sk", True),
    ("fact_test_step_result", "test_run_id", "fact_test_run", "test_run_id", True),
    ("fact_requirement_coverage", "issue_sk", "dim_issue", "issue_sk", True),
    ("fact_requirement_coverage", "release_sk", "dim_release", "release_sk", True),
    ("fact_requirement_coverage", "latest_execution_date_sk", "dim_date", "date_sk", False),
    ("fact_defect_link", "release_sk", "dim_release", "release_sk", True),
    ("fact_defect_link", "defect_sk", "dim_defect", "defect_sk", True),
    ("fact_cycle_snapshot", "release_sk", "dim_release", "release_sk", True),
    ("fact_cycle_snapshot", "squad_sk", "dim_squad", "squad_sk", True),
    ("fact_cycle_snapshot", "snapshot_date_sk", "dim_date", "date_sk", False),
    ("dim_test", "test_type_sk", "dim_test_type", "test_type_sk", True),
    ("dim_test", "squad_sk", "dim_squad", "squad_sk", False),
    ("dim_defect", "squad_sk", "dim_squad", "squad_sk", False),
    ("dim_defect", "application_sk", "dim_application", "application_sk", False),
    ("dim_issue", "squad_sk", "dim_squad", "squad_sk", False),
    ("dim_squad", "program_sk", "dim_program", "program_sk", True),
    ("dim_squad", "application_sk", "dim_application", "application_sk", False),
    ("dim_application", "program_sk", "dim_program", "program_sk", True),
    ("bridge_squad_user", "squad_sk", "dim_squad", "squad_sk", True),
    ("dim_release", "release_date_sk", "dim_date", "date_sk", False),
)

# How each star is walked out from a fact: dimension -> (table that leads to it).
_LEADS = {
    "fact_test_run": {"dim_squad": "dim_test", "dim_test_type": "dim_test", "dim_program": "dim_squad", "dim_application": "dim_squad"},
    "fact_requirement_coverage": {"dim_squad": "dim_issue", "dim_program": "dim_squad", "dim_application": "dim_squad"},
    "fact_defect_link": {"dim_squad": "dim_defect", "dim_program": "dim_squad", "dim_application": "dim_defect"},
    "fact_cycle_snapshot": {"dim_program": "dim_squad", "dim_application": "dim_squad"},
    "dim_defect": {"dim_program": "dim_squad"},
    "dim_issue": {"dim_program": "dim_squad"},
}


def edge(table: str, dimension: str) -> tuple[str, str]:
    for source, column, target, key, _ in RELATIONSHIPS:
        if (source, target) == (table, dimension):
            return column, key
    raise KeyError(f"no relationship from {table} to {dimension}")


def path_to(fact: str, dimension: str) -> list[tuple[str, str, str, str]]:
    """Edges (table, column, dimension, key) from ``fact`` out to ``dimension``."""
    before = _LEADS.get(fact, {}).get(dimension, fact)
    steps = [] if before == fact else path_to(fact, before)
    return [*steps, (before, edge(before, dimension)[0], dimension, edge(before, dimension)[1])]


def with_dims(t: Star, fact: str, wanted: dict[str, list[str]], how: str = "left") -> DataFrame:
    """The fact with columns of dimensions attached, e.g. ``{"dim_squad": ["squad_name"]}``.

    Only keys and wanted columns are read. A dimension's key columns needed for the way on are
    prefixed, so equal names of fact and dimension do not clash.
    """
    df, joined = t[fact], {fact: ""}
    for dimension in wanted:
        for table, column, target, key in path_to(fact, dimension):
            if target in joined:
                continue
            prefix = f"_{target}_"
            onward = {
                edge(target, d)[0]
                for d in {x for w in wanted for _, _, x, _ in path_to(fact, w)}
                if any(r[0] == target and r[2] == d for r in RELATIONSHIPS)
            }
            columns = [F.col(key).alias(prefix + key)]
            columns += [F.col(c).alias(prefix + c) for c in sorted(onward - {key})]
            columns += [F.col(c) if isinstance(c, str) else c for c in wanted.get(target, [])]
            df = df.join(t[target].select(*columns), F.col(joined[table] + column) == F.col(prefix + key), how)
            joined[target] = prefix
    return df.drop(*[c for c in df.columns if c.startswith("_dim_")])


def with_date(t: Star, df: DataFrame, column: str, role: str) -> DataFrame:
    """Attach the calendar in a given role (J10): run, snapshot, release or coverage date."""
    days = t["dim_date"].select(
        F.col("date_sk").alias("_sk"),
        *[F.col(c).alias(f"{role}_{c}") for c in ("full_date", "year", "month", "week_of_year")],
    )
    return df.join(days, F.col(column) == F.col("_sk"), "left").drop("_sk")


@dataclass(frozen=True)
class Context:
    """Slicer choices of a page; an empty choice does not filter."""

    releases: tuple[str, ...] = ()
    squads: tuple[str, ...] = ()
    programs: tuple[str, ...] = ()
    environments: tuple[str, ...] = ()
    first_day: date | None = None
    last_day: date | None = None
    tests: tuple[str, ...] = field(default=())
    defects: tuple[str, ...] = field(default=())


def _chosen(t: Star, dimension: str, name: str, values: tuple[str, ...]) -> DataFrame:
    return t[dimension].where(F.col(name).isin(*values))


def apply_context(t: Star, ctx: Context) -> Star:
    """The star as a page with these choices sees it.

    Dimension filters reach the facts by semi-joins along the relationships; the squad filter uses
    the test, issue and defect to squad edges, which are inactive by default.
    """
    frames: dict[str, DataFrame] = {}
    get = lambda name: frames.get(name, t[name])

    def restrict(table: str, column: str, allowed: DataFrame, key: str) -> None:
        frames[table] = get(table).join(allowed.select(F.col(key).alias(column)).distinct(), column, "left_semi")

    if ctx.releases:
        chosen = _chosen(t, "dim_release", "release_name", ctx.releases)
        frames["dim_release"] = chosen
        for table in ("fact_test_run", "fact_requirement_coverage", "fact_defect_link", "fact_cycle_snapshot"):
            if table in t:
                restrict(table, "release_sk", chosen, "release_sk")
    if ctx.squads or ctx.programs:
        squads = t["dim_squad"]
        if ctx.squads:
            squads = squads.where(F.col("squad_name").isin(*ctx.squads))
        if ctx.programs:
            programs = _chosen(t, "dim_program", "program_name", ctx.programs)
            frames["dim_program"] = programs
            squads = squads.join(programs.select("program_sk"), "program_sk", "left_semi")
        restrict_to_squads(t, frames, squads)
    if ctx.environments:
        chosen = _chosen(t, "dim_environment", "environment_name", ctx.environments)
        frames["dim_environment"] = chosen
        restrict("fact_test_run", "environment_sk", chosen, "environment_sk")
    if ctx.tests:
        chosen = get("dim_test").where(F.col("test_key").isin(*ctx.tests))
        frames["dim_test"] = chosen
        restrict("fact_test_run", "test_sk", chosen, "test_sk")
    if ctx.defects:
        links = get("fact_defect_link").where(F.col("defect_key").isin(*ctx.defects))
        frames["fact_defect_link"] = links
        restrict("fact_test_run", "test_run_id", links, "test_run_id")
    if ctx.first_day or ctx.last_day:
        sk = F.col("date_sk")
        keep = F.lit(True)
        if ctx.first_day:
            keep &= sk >= int(ctx.first_day.strftime("%Y%m%d"))
        if ctx.last_day:
            keep &= sk <= int(ctx.last_day.strftime("%Y%m%d"))
        frames["dim_date"] = get("dim_date").where(keep)
        runs = get("fact_test_run").where(keep)
        if "month" in runs.columns:  # published runs lie in folders by month; only those of the days are read
            months = [F.lit(True)]
            months += [F.col("month") >= int(ctx.first_day.strftime("%Y%m"))] if ctx.first_day else []
            months += [F.col("month") <= int(ctx.last_day.strftime("%Y%m"))] if ctx.last_day else []
            runs = runs.where(reduce(and_, months) | F.col("month").isNull())
        frames["fact_test_run"] = runs
    steps_of_runs(t, frames)
    return t.replace(**frames)


def steps_of_runs(t: Star, frames: dict[str, DataFrame]) -> None:
    """A filter on runs reaches their steps."""
    steps = "fact_test_step_result"
    if steps in t and "fact_test_run" in frames:
        runs = frames["fact_test_run"].select("test_run_id").distinct()
        frames[steps] = frames.get(steps, t[steps]).join(runs, "test_run_id", "left_semi")


def restrict_to_squads(t: Star, frames: dict[str, DataFrame], squads: DataFrame) -> None:
    """Keep only rows that belong to the given squads, in every table that leads to a squad."""
    allowed = squads.select("squad_sk").distinct()
    frames["dim_squad"] = squads
    for table in ("dim_test", "dim_issue", "dim_defect", "dim_test_plan", "fact_cycle_snapshot", "bridge_squad_user"):
        if table in t:
            frames[table] = frames.get(table, t[table]).join(allowed, "squad_sk", "left_semi")
    for fact, key, dimension in (
        ("fact_test_run", "test_sk", "dim_test"),
        ("fact_requirement_coverage", "issue_sk", "dim_issue"),
        ("fact_defect_link", "defect_sk", "dim_defect"),
    ):
        if fact in t and dimension in frames:
            frames[fact] = frames.get(fact, t[fact]).join(frames[dimension].select(key), key, "left_semi")
    for bridge in ("bridge_issue_test", "bridge_issue_release"):
        if bridge in t and "dim_issue" in frames:
            frames[bridge] = frames.get(bridge, t[bridge]).join(frames["dim_issue"].select("issue_key"), "issue_key", "left_semi")
    steps_of_runs(t, frames)
