"""Helpers the operators share: stored tables, partition counts and gapless numbering."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qualitymart.session import remove, shared_folder

#: Folders of the tables that the step at hand has stored (``only_last``).
_STORED: ContextVar[list[str] | None] = ContextVar("stored", default=None)


def partitions(spark: SparkSession) -> int:
    """How many tasks a shuffle of this session has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Texts can be long, and an Arrow batch of them is held by the executor and by its Python worker: from
    here on batches of this session have at most ``rows`` rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs that run inside, where several texts travel in a row."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder that all executors share."""
    return f"{shared_folder(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Several readers then share one computation, and a lost executor costs no recomputation.
    """
    path = new_folder(df.sparkSession, name)
    if (folders := _STORED.get()) is not None:
        folders.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def only_last(spark: SparkSession, step: Callable[[], DataFrame]) -> DataFrame:
    """What ``step()`` returns, which reads the table that it stored last and none of those it stored before.

    The earlier ones are deleted then. If the step fails, all of them are.
    """
    outer, folders, kept = _STORED.get(), [], []
    token = _STORED.set(folders)
    try:
        found = step()
        kept = folders[-1:]
    finally:
        _STORED.reset(token)
        for folder in folders[: len(folders) - len(kept)]:
            remove(spark, folder)
    if outer is not None:
        outer += kept
    return found


def numbered(df: DataFrame, group: list[str], spread: Column, order: list[Column], name: str) -> DataFrame:
    """Number the rows of each ``group`` from 0 without a gap, as column ``name``.

    A group may hold a third of all rows, so no task gets a whole one: rows are numbered inside hash
    buckets of their group, and every bucket is shifted by the sizes of the group's earlier buckets.
    ``spread`` decides the bucket, ``order`` the place inside it.
    """
    n = partitions(df.sparkSession)
    rows = df.withColumn("_bucket", F.pmod(F.xxhash64(spread), F.lit(n)).cast("int"))
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order)
    rows = rows.withColumn("_place", F.row_number().over(inside).cast("long") - 1)
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        df.groupBy(*group, F.pmod(F.xxhash64(spread), F.lit(n)).cast("int").alias("_bucket"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_shift", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    joined = rows.join(sizes, [*group, "_bucket"])
    return joined.withColumn(name, F.col("_place") + F.col("_shift")).drop("_bucket", "_place", "_shift")
