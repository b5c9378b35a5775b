"""Row-level security."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualitymart.plans.context import restrict_to_squads
from qualitymart.sources.star import Star

MEMBER, MANAGER, EXECUTIVE = "Squad_Member", "Program_Manager", "CXO"


def member_squads(t: Star, email: str) -> DataFrame:
    """Squads the user is linked to."""
    mine = t["bridge_squad_user"].where(F.col("user_email") == email).select("squad_sk")
    return t["dim_squad"].join(mine, "squad_sk", "left_semi")


def manager_squads(t: Star, email: str) -> DataFrame:
    """All squads of the programs in which the user manages a squad (R2)."""
    managed = (
        t["bridge_squad_user"].where((F.col("user_email") == email) & F.col("role").isin(MANAGER, EXECUTIVE)).select("squad_sk")
    )
    programs = t["dim_squad"].join(managed, "squad_sk", "left_semi").select("program_sk")
    return t["dim_squad"].join(programs, "program_sk", "left_semi")


def visible_squads(t: Star, email: str, role: str | None) -> DataFrame:
    if role == EXECUTIVE:
        return t["dim_squad"]
    if role == MANAGER:
        return manager_squads(t, email)
    if role == MEMBER:
        return member_squads(t, email)
    return t["dim_squad"].where(F.lit(False))


def secure(t: Star, email: str, role: str | None) -> Star:
    """The star as a user in a role sees it.

    An executive sees all. Others see what leads to their squads: tests, requirements and defects, their
    runs, steps, coverage, links and snapshots; of the users only themselves. Tables without a way to a
    squad are open to every role. A user without a role gets no row of any table.
    """
    if role == EXECUTIVE:
        return t
    if role not in (MEMBER, MANAGER):
        return t.replace(**{name: t[name].where(F.lit(False)) for name in t})
    frames: dict[str, DataFrame] = {}
    restrict_to_squads(t, frames, visible_squads(t, email, role))
    own = F.col("user_email") == email
    if role == MANAGER:
        own &= F.col("role").isin(MANAGER, EXECUTIVE)
    return t.replace(**{**frames, "bridge_squad_user": t["bridge_squad_user"].where(own)})


def visibility(t: Star, email: str, role: str | None) -> DataFrame:
    """``tbl, visible, total``: how many rows of each table the user sees, and how many there are."""
    frames = {name: t[name] for name in sorted(t)}  # loaded once, so that a table open to the role is known by it
    seen = secure(t, email, role)
    rows: DataFrame | None = None
    for name, frame in frames.items():
        for columns, counted in (({"visible", "total"}, frame),) if seen[name] is frame else (({"visible"}, seen[name]), ({"total"}, frame)):
            n = counted.agg(F.count(F.lit(1)).alias("n"))
            row = n.select(F.lit(name).alias("tbl"), *[(F.col("n") if c in columns else F.lit(0).cast("bigint")).alias(c) for c in ("visible", "total")])
            rows = row if rows is None else rows.unionByName(row)
    return rows.groupBy("tbl").agg(F.sum("visible").alias("visible"), F.sum("total").alias("total"))


def user_lookup(t: Star, email: str) -> DataFrame:
    """Squads and roles of one user."""
    mine = t["bridge_squad_user"].where(F.col("user_email") == email)
    return mine.join(t["dim_squad"].select("squad_sk", "squad_name"), "squad_sk").select("user_email", "squad_name", "role")


def access_audit(t: Star) -> DataFrame:
    """Who may see which squads, as one line per user and role."""
    pairs = t["bridge_squad_user"].join(t["dim_squad"].select("squad_sk", "squad_name"), "squad_sk")
    in_order = F.expr("listagg(squad_name, ', ') WITHIN GROUP (ORDER BY squad_name)")
    return pairs.groupBy("user_email", "role").agg(in_order.alias("squads"))
