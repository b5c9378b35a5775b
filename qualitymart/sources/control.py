"""Watermarks and the run log of jobs.

Both are append-only folders of small rows; the state of a job is its newest row.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualitymart import schemas as S
from qualitymart.session import no_rows, read_or_none


PURGES = "project STRING, purged_at TIMESTAMP"
BATCHES = "stream STRING, batch_id BIGINT"


def _utc(ts: datetime | None) -> datetime | None:
    """A time without zone is read as UTC."""
    return ts.replace(tzinfo=timezone.utc) if ts is not None and ts.tzinfo is None else ts


class Control:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _events(self, table: str) -> DataFrame:
        events = read_or_none(self.spark, S.struct(table), f"{self.root}/{table}")
        return S.empty(self.spark, table) if events is None else events

    def _append(self, table: str, row: dict) -> None:
        values = [tuple(row.get(c) for c in S.columns(table))]
        self.spark.createDataFrame(values, S.struct(table)).coalesce(1).write.mode("append").parquet(f"{self.root}/{table}")

    def watermarks(self) -> DataFrame:
        """Current watermarks: per job that of its loads of all projects, and one per project loaded by itself."""
        last = self._events("pipeline_watermarks").groupBy("job_name", "project").agg(
            F.max(F.struct("updated_at", "last_success_ts")).alias("_last")
        )
        return last.select("job_name", "_last.last_success_ts", "_last.updated_at", "project")

    def get_watermark(self, job: str, projects: Sequence[str] = ()) -> datetime | None:
        """From when on a load has to read: the mark of all projects, or the least of the given ones.

        A project has been read up to its own mark or that of all, whichever is later.
        """
        own = F.col("project").isNull() | F.col("project").isin(*projects)
        marks = self.watermarks().where((F.col("job_name") == job) & own).select("project", F.unix_micros("last_success_ts").alias("micros"))
        found = {r["project"]: r["micros"] for r in marks.collect()}
        of_all = found.get(None)
        least = [max((m for m in (found.get(p), of_all) if m is not None), default=None) for p in projects] or [of_all]
        return None if None in least else datetime.fromtimestamp(min(least) / 1e6, tz=timezone.utc)

    def set_watermark(self, job: str, ts: datetime, now: datetime | None = None, projects: Sequence[str] = ()) -> None:
        now = _utc(now) or datetime.now(tz=timezone.utc)
        for project in projects or (None,):
            self._append("pipeline_watermarks", {"job_name": job, "last_success_ts": _utc(ts), "updated_at": now, "project": project})

    def add_batch(self, stream: str, batch_id: int) -> None:
        """Note that a stream's batch has been published."""
        self.spark.createDataFrame([(stream, batch_id)], BATCHES).coalesce(1).write.mode("append").parquet(f"{self.root}/stream_batches")

    def has_batch(self, stream: str, batch_id: int) -> bool:
        events = read_or_none(self.spark, BATCHES, f"{self.root}/stream_batches")
        return events is not None and not events.where((F.col("stream") == stream) & (F.col("batch_id") == batch_id)).isEmpty()

    def purges(self) -> DataFrame:
        """Projects taken out, with the time up to which what was staged of them is void."""
        events = read_or_none(self.spark, PURGES, f"{self.root}/pipeline_purges")
        return no_rows(self.spark, PURGES) if events is None else events

    def add_purge(self, project: str, now: datetime | None = None) -> None:
        row = [(project, _utc(now) or datetime.now(tz=timezone.utc))]
        self.spark.createDataFrame(row, PURGES).coalesce(1).write.mode("append").parquet(f"{self.root}/pipeline_purges")

    def run_log(self) -> DataFrame:
        """One row per job run: its final state once it has finished."""
        order = F.struct(F.col("finished_at").isNotNull(), "finished_at")
        rest = [c for c in S.columns("pipeline_run_log") if c != "pipeline_run_id"]
        last = self._events("pipeline_run_log").groupBy("pipeline_run_id").agg(F.max_by(F.struct(*rest), order).alias("_last"))
        return last.select("pipeline_run_id", "_last.*")

    def start_run(self, job: str, watermark_before: datetime | None = None, now: datetime | None = None) -> dict:
        run = {
            "pipeline_run_id": str(uuid.uuid4()),
            "job_name": job,
            "status": "running",
            "started_at": _utc(now) or datetime.now(tz=timezone.utc),
            "watermark_before": _utc(watermark_before),
        }
        self._append("pipeline_run_log", run)
        return run

    def finish_run(self, run: dict, status: str, now: datetime | None = None, **outcome) -> None:
        """``outcome``: records_extracted, rows_processed, rows_upserted, watermark_after, error_message."""
        finished = {"finished_at": _utc(now) or datetime.now(tz=timezone.utc), "status": status, "alert_sent": False}
        self._append("pipeline_run_log", {**run, "records_extracted": 0, "rows_processed": 0, "rows_upserted": 0, **finished, **outcome})
