"""Delta loads as a Structured Streaming query over the staging area.

The stream's checkpoint takes the place of the stored watermark: each staged file is applied once.
State lives in the published tables, and applying a batch again gives the same tables. With ``Control`` a batch that was
published before the stream could note it is recognised, and what is void by a purge is left out.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from qualitymart.functions.fieldmap import FieldMap
from qualitymart.plans import loads
from qualitymart.session import configure, remove
from qualitymart.sources import staging
from qualitymart.sources.control import Control
from qualitymart.sources.warehouse import Warehouse


def start(
    spark: SparkSession,
    staging_root: str,
    warehouse_root: str,
    checkpoint: str,
    as_of: date,
    fields_map: FieldMap | None = None,
    files_per_batch: int | None = None,
    control: Control | None = None,
) -> StreamingQuery:
    """Apply all staged files not applied yet, then stop. The stream is known to ``control`` by its checkpoint."""
    configure(spark)
    reader = spark.readStream.schema(staging.LAYOUT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(staging_root)

    def apply(batch: DataFrame, batch_id: int) -> None:
        if control is not None and control.has_batch(checkpoint, batch_id):
            return
        records = batch if control is None else staging.without_purged(batch, control.purges())
        # stored per entity: Spark takes a batch for rows of which it knows nothing, and would read all of it for each entity
        folder = f"{warehouse_root.rstrip('/')}/_prepared/batch-{uuid.uuid4().hex}"
        staging.write(records.drop("load_date"), folder)
        loads.transform(staging.scan(spark, folder), Warehouse(spark, warehouse_root), as_of, fields_map)
        remove(spark, folder)
        if control is not None:
            control.add_batch(checkpoint, batch_id)

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
