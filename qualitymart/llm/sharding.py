"""Best-fit-decreasing sharding: groups of equal texts stay whole and enter the tightest shard they fit.

Placing groups one by one would need one task, so the plan is made from counts. Groups of nearly the same
size form a class; there are at most 64 * ``STEPS`` classes, exact sizes up to ``2 * STEPS`` bytes. A class
of n groups enters the shards as n equal items would: the tightest shard takes as many as fit, then the
next. Groups are numbered within their class in parallel, and the number of a group decides its shard.
The shard capacity is the smallest at which all groups fit into the given number of shards.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitymart.llm.common import numbered, stored

#: Size classes between two powers of two.
STEPS = 1024


def size_class(size: Column) -> Column:
    """A number that grows with the size and is its own for every size up to ``2 * STEPS``."""
    power = F.greatest(F.floor(F.log2(size)) - int(np.log2(STEPS)), F.lit(0)).cast("int")
    return (power * STEPS + F.floor(size / F.pow(F.lit(2.0), power))).cast("long")


def place(classes: list[tuple[int, int, float]], capacity: float, shards: int | None) -> tuple[list[tuple[int, int, int]], int] | None:
    """Runs ``(class, first number, shard)`` and the shards used, for classes ``(class, groups, size)``
    with larger sizes first. None if they don't fit into ``shards`` shards; those that are open are kept
    in order of the space left, as a balanced tree would, and found by bisection."""
    open_: list[tuple[float, int]] = []
    runs: list[tuple[int, int, int]] = []
    used = 0
    for kind, groups, size in classes:
        done = 0
        while done < groups:
            at = bisect_left(open_, (size - 1e-6, -1))
            if at < len(open_):
                space, shard = open_.pop(at)
            elif shards is None or used < shards:
                space, shard, used = max(capacity, size), used, used + 1
            else:
                return None
            n = min(groups - done, max(1, int((space + 1e-6) // size)))
            runs.append((kind, done, shard))
            done += n
            insort(open_, (space - n * size, shard))
    return runs, used


def shard_plan(classes: list[tuple[int, int, float]], shards: int) -> list[tuple[int, int, int]]:
    """Runs that put all groups into ``shards`` shards of nearly equal bytes.

    A group of more than an even share gets a shard of its own; for the others the smallest capacity
    at which they fit is searched by halving.
    """
    left = [[kind, groups, size] for kind, groups, size in sorted(classes, key=lambda c: -c[2])]
    total, free, own = sum(n * size for _, n, size in left), shards, []
    while left and free > 1 and left[0][2] >= total / free:
        kind, groups, size = left[0]
        n = min(groups, free - 1, max(1, int(total // size)))
        own += [(kind, k, shards - free + k) for k in range(n)]
        free, total = free - n, total - n * size
        left[0][1] -= n
        if not left[0][1]:
            left.pop(0)
        else:
            break
    moved = {kind: k + 1 for kind, k, _ in own}
    rest = [(kind, groups, size) for kind, groups, size in left]
    low, high = total / free, 2 * total / free + max((s for *_, s in rest), default=0)
    best = place(rest, high, free)
    for _ in range(40):
        middle = (low + high) / 2
        found = place(rest, middle, free)
        if found:
            best, high = found, middle
        else:
            low = middle
        if high - low < 0.5:
            break
    return own + [(kind, first + moved.get(kind, 0), shard + shards - free) for kind, first, shard in best[0]]


def shard(docs: DataFrame, shards: int | None = 24, capacity: int | None = None, overhead: int = 8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    A row's size is the UTF-8 bytes of its text plus ``overhead``; a null text has no bytes, the checksum
    of an empty text and a group of its own. Give a number of shards (law ``bytes``: sizes near equal) or a
    ``capacity`` in bytes (the number of shards follows; a larger group has a shard to itself). ``slot``
    numbers a shard's rows from 0; ``grown_shard`` is null, as adding a shard places the groups anew.
    Repeated rows are equal texts. An empty table gives no rows.
    """
    text = F.col(text_column)
    rows = docs.select(
        F.col(id_column).alias("_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + overhead).alias("_size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("_crc"),
        F.coalesce(F.sha2(text.cast("binary"), 256), F.lit("")).alias("_key"),
    )
    rows = stored(rows, "sizes")
    groups = rows.groupBy("_key").agg(F.sum("_size").alias("_bytes")).withColumn("_class", size_class(F.col("_bytes")))
    # in shards of a fixed capacity every group of a class is taken to be as large as the largest
    size = F.avg("_bytes") if capacity is None else F.max("_bytes")
    classes = [(r[0], r[1], float(r[2])) for r in groups.groupBy("_class").agg(F.count(F.lit(1)), size).collect()]
    if capacity is not None:
        planned = place(sorted(classes, key=lambda c: -c[2]), capacity, None)[0]
    else:
        planned = shard_plan(classes, shards)
    table = np.array(sorted(planned), np.int64).reshape(-1, 3)
    keys = table[:, 0] << 44 | table[:, 1]

    def choose(batches):
        for batch in batches:
            number = batch.column(1).to_numpy(zero_copy_only=False) << 44 | batch.column(2).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, number, side="right") - 1
            yield pa.record_batch([batch.column(0), pa.array(table[at, 2].astype(np.int32))], ["_key", "shard"])

    ranked = numbered(groups, ["_class"], F.col("_key"), [F.col("_key")], "_number")
    chosen = ranked.select("_key", "_class", "_number").mapInArrow(choose, "_key string, shard int")
    sharded = rows.join(chosen, "_key")
    row = [F.col(c) for c in ("_id", "_key")]
    slotted = numbered(sharded, ["shard"], F.struct("_id", "_key"), row, "slot")
    return slotted.select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
