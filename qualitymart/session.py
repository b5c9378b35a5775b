"""Session settings the engine relies on."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Runtime settings: all of them can be changed on a running session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A payload with a repeated key keeps the last value instead of being rejected.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def local_session(
    cpus: int | str = 8, shuffle_partitions: int | None = None, memory: str = "12g", folder: str | None = None
) -> SparkSession:
    """A local session for tests and bench, which keep what they store in ``folder``; on a cluster the session comes
    from spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("qualitymart")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    )
    if folder:
        builder = builder.config("spark.checkpoint.dir", folder).config("spark.sql.warehouse.dir", f"{folder}/warehouse")
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; where that is unset, one inside the warehouse.

    On a cluster that leaves the warehouse on a local disk as well there is no such folder, which is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_stored"


def _folder(spark: SparkSession, path: str):
    """A path and the file system it is in, whichever that is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def read_or_none(spark: SparkSession, layout: str | StructType, path: str, nested: bool = False) -> DataFrame | None:
    """A Parquet folder, or None if there is none yet. Any failure to read it is raised."""
    folder, files = _folder(spark, path)
    return spark.read.schema(layout).option("recursiveFileLookup", nested).parquet(path) if files.exists(folder) else None


def together(*tasks: Callable) -> list:
    """Results of functions that don't depend on each other, run at the same time: most jobs of a load are short, so that one
    after the other leave most cores idle. What a function raises is raised when all have ended."""
    session = SparkSession.getActiveSession()
    inheriting = inheritable_thread_target if session is None else inheritable_thread_target(session)
    with ThreadPoolExecutor(len(tasks) or 1) as pool:
        running = [pool.submit(inheriting(task)) for task in tasks]
    return [each.result() for each in running]


def no_rows(spark: SparkSession, layout: str | StructType) -> DataFrame:
    """An empty table that the optimizer knows to be empty: joins with it are taken out of a plan, where rows of Python would
    be taken for many."""
    fields = StructType.fromDDL(layout) if isinstance(layout, str) else layout
    return spark.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def parts_in(spark: SparkSession, path: str, division: str) -> set[int]:
    """Values of an integer column by which a folder is divided, from the names of its folders; no row is read."""
    folder, files = _folder(spark, path)
    names = [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []
    return {int(name.split("=", 1)[1]) for name in names if name.startswith(f"{division}=") and not name.endswith("=__HIVE_DEFAULT_PARTITION__")}


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def move(spark: SparkSession, path: str, to: str) -> bool:
    """Put a folder in the place of another one, if it is there."""
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return False
    place, _ = _folder(spark, to)
    files.delete(place, True)
    files.mkdirs(place.getParent())
    if not files.rename(folder, place):
        raise OSError(f"{path} could not be moved to {to}")
    return True


#: A side of a join with more rows is dealt out by key, not sent whole to the driver and every executor.
MANY = 200_000


def is_many(df: DataFrame) -> bool:
    """Whether stored rows are more than a join may broadcast; reads at most that many of each partition.

    Spark's own estimate doesn't tell: rows that come out of an exploded VARIANT are taken for a fortieth of their size or less.
    """
    return df.limit(MANY + 1).count() > MANY


def dealt(df: DataFrame, many: bool = True) -> DataFrame:
    """``df``, marked to be shuffled by the join that follows if it has many rows."""
    return df.hint("merge") if many else df


def sized(df: DataFrame) -> DataFrame:
    """Stored rows (``cut``), marked by their number."""
    return dealt(df, is_many(df))


def spread(df: DataFrame, *by: str) -> DataFrame:
    """``df`` dealt out over as many tasks as the session has shuffle partitions, for rows from which much is made.

    A Parquet file may be one row group, which one task reads, however many cores there are.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the shared folder: for wide rows that are read several times, each time some columns."""
    folder = f"{shared_folder(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that lost executors need not recompute it."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
