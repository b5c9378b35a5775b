"""Staging area: raw JSON records by entity type.

Writes only append, partitioned by entity type and load day; the upsert on (source_key, run_id)
is resolved when reading, where the latest load of a key wins. A retried write is harmless.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qualitymart import schemas as S
from qualitymart.functions import scalars as X
from qualitymart.session import read_or_none, remove

LAYOUT = S.STAGING + ", load_date DATE"


def known(records: DataFrame) -> DataFrame:
    return records.where(F.col("entity_type").isin(*S.ENTITY_TYPES))


def unknown(records: DataFrame) -> DataFrame:
    """Records of no known entity type; they are not staged."""
    other = records.where(~F.coalesce(F.col("entity_type").isin(*S.ENTITY_TYPES), F.lit(False)))
    return other.select(
        F.coalesce("source_key", F.lit("")).alias("source"), F.lit("unknown_entity").alias("reason"), F.col("raw_json").alias("body")
    )


def write(records: DataFrame, root: str) -> None:
    """Append the records of known types."""
    dated = known(records).withColumn("load_date", F.to_date("loaded_at"))
    dated.write.mode("append").partitionBy("entity_type", "load_date").parquet(root)


def project_of(records: DataFrame) -> Column:
    """Project of a staged record: of its key, for versions the one they are stamped with, for runs and steps that
    of their execution."""
    # a payload is not parsed for a key whose letters it doesn't contain, unless some of its letters are escaped
    may_hold = lambda key: F.contains("raw_json", F.lit(key)) | F.contains("raw_json", F.lit("\\"))
    stamped = F.coalesce(*[F.when(may_hold(key), F.get_json_object("raw_json", f"$.{key}")) for key in ("_project_key", "_execution_key")])
    owned = F.col("entity_type").isin("jira_version", "xray_test_run", "xray_test_step_result")
    return F.substring_index(F.when(owned, stamped).otherwise(F.col("source_key")), "-", 1)


def of_projects(records: DataFrame, projects: Sequence[str]) -> DataFrame:
    """Records of some projects; payloads pass through a generator, so that the filter can't make Spark build them again."""
    once = [F.explode(F.array(c)).alias(c) if c == "raw_json" else F.col(c) for c in records.columns]
    built = records.select(*once)
    return built.where(F.coalesce(project_of(built).isin(*projects), F.lit(False)))


def without_purged(records: DataFrame, purged: DataFrame) -> DataFrame:
    """Records but for those staged of a project before it was purged (``project, purged_at``).

    The purged projects, one row each, are sent to the records: dealt out by project, all records of one would meet in a task.
    """
    last = F.broadcast(purged.groupBy("project").agg(F.max("purged_at").alias("_purged_at")))
    void = (project_of(records) == F.col("project")) & (F.col("loaded_at") <= F.col("_purged_at"))
    return records.join(last, void, "left_anti")


def scan(
    spark: SparkSession, root: str, entity: str | None = None, since: datetime | None = None, mode: str = "full_refresh",
    purged: DataFrame | None = None,
) -> DataFrame:
    """Staged records, one per (source_key, run_id); in incremental mode only loads after ``since`` (F1).

    The type and load day are partition columns, so a delta reads only recent folders. What was staged of a
    project before it was purged (``purged``: project, purged_at) is left out.
    """
    records = spark.read.schema(LAYOUT).parquet(root)
    if purged is not None:
        records = without_purged(records, purged)
    if entity is not None:
        records = records.where(F.col("entity_type") == entity)
    if mode == "incremental" and since is not None:
        records = records.where((F.col("load_date") >= F.to_date(F.lit(since))) & (F.col("loaded_at") > F.lit(since)))
    return latest_per_load(records.drop("load_date"))


def compact(spark: SparkSession, root: str, before: date, purged: DataFrame | None = None) -> None:
    """Rewrite closed load days (before a day) as the last record per key and run, in files of the session's target size.

    Safe for a running reader: the rewritten records are added first, and a scan takes one of equal records; the files
    they replace are only noted, and stay until ``sweep``. A stream over the folder sees the new files and applies the
    same records once more.
    """
    closed = spark.read.schema(LAYOUT).parquet(root).where(F.col("load_date") < F.lit(before))
    note = closed.select(F.col("_metadata.file_path").alias("path")).distinct().withColumn("replaced_at", F.current_timestamp())
    note.write.parquet(f"{root}/_replaced/{uuid.uuid4().hex}")
    records = closed if purged is None else without_purged(closed, purged)
    dated = latest_per_load(records.drop("load_date")).withColumn("load_date", F.to_date("loaded_at"))
    dated.hint("rebalance", "entity_type", "load_date").write.mode("append").partitionBy("entity_type", "load_date").parquet(root)


def sweep(spark: SparkSession, root: str, replaced_before: datetime | None = None) -> int:
    """Delete files that were replaced before a moment (by default all), once no reader can be using them any more."""
    notes = read_or_none(spark, "path STRING, replaced_at TIMESTAMP", f"{root}/_replaced", nested=True)
    if notes is None:
        return 0
    old = notes if replaced_before is None else notes.where(F.col("replaced_at") < F.lit(replaced_before))
    paths = [r["path"] for r in old.select("path").distinct().toLocalIterator()]  # names of files, not records
    for path in paths:
        remove(spark, path)
    return len(paths)


def latest_per_load(records: DataFrame) -> DataFrame:
    """Last record per entity, key and run; a maximum, so it is combined before the shuffle."""
    keys = ["entity_type", "source_key", "run_id"]
    last = records.groupBy(*keys).agg(F.max(F.struct("loaded_at", "raw_json")).alias("_last"))
    return last.select("run_id", "source_key", "entity_type", "_last.raw_json", "_last.loaded_at")


def parse(records: DataFrame, kind: str | None = None) -> DataFrame:
    """(source_key, v, ord): payloads as VARIANT, or cast to ``kind`` at once; bad JSON is left out.

    ``ord`` orders deliveries: a later load wins over an earlier one (I5), within a load the higher key.
    """
    order = F.struct("loaded_at", "run_id", "source_key")
    if kind is None:
        return records.select("source_key", order.alias("ord"), F.explode(X.parsed_values("raw_json")).alias("v"))
    return records.select("source_key", order.alias("ord"), F.inline(X.parsed_as("raw_json", kind)))


def bad_json(records: DataFrame) -> DataFrame:
    """Records that parse leaves out."""
    return records.where(X.parse_json("raw_json").isNull()).select(
        F.col("source_key").alias("source"), F.lit("bad_json").alias("reason"), F.col("raw_json").alias("body")
    )
