"""Token ids as wavelet matrices: one succinct file per range of document ids.

Documents are range-partitioned by id; each task encodes its texts in order and writes shards of about
``SHARD_TOKENS`` ids. A shard is a wavelet matrix: bit-plane ``p`` holds, in the order that the planes
above it have sorted the ids into, one bit of each id. With the ranks at every 512th bit, the shard
answers which id is at a place, how often an id occurs and where, without the ids being unpacked.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qualitymart.llm.common import partitions, small_batches
from qualitymart.llm.token_counts import texts_of
from qualitymart.llm.tokens import load

SHARD_TOKENS = 1 << 20
#: Characters of texts that are encoded together.
GROUP_CHARS = 1 << 22
#: Bits between two stored ranks.
BLOCK = 512
SHARD = "part int, before long, n_tokens long, doc_ids array<long>, lengths array<int>, zeros array<int>, planes array<binary>, ranks array<binary>"


@dataclass
class WaveletMatrix:
    """Bit-planes from the highest bit down, the zeros in each, and the ones before each block."""

    n: int
    zeros: list[int]
    planes: list[bytes]
    ranks: list[bytes]

    @classmethod
    def build(cls, ids: np.ndarray, depth: int) -> WaveletMatrix:
        zeros, planes, ranks = [], [], []
        for level in range(depth - 1, -1, -1):
            bits = (ids >> level) & 1 != 0
            packed = np.packbits(bits, bitorder="little")
            ones = np.add.reduceat(np.bitwise_count(packed), np.arange(0, len(packed), BLOCK // 8), dtype=np.uint32) if len(packed) else np.zeros(0, np.uint32)
            low = ids[~bits]
            zeros.append(len(low))
            planes.append(packed.tobytes())
            ranks.append(np.concatenate([[0], np.cumsum(ones)]).astype("<u4").tobytes())
            ids = np.concatenate([low, ids[bits]])
        return cls(int(len(ids)), zeros, planes, ranks)

    def _bits(self, k: int) -> np.ndarray:
        return np.unpackbits(np.frombuffer(self.planes[k], np.uint8), count=self.n, bitorder="little").view(bool)

    def rank(self, k: int, i: int) -> int:
        """Ones among the first ``i`` bits of plane ``k``."""
        block = i // BLOCK
        tail = np.frombuffer(self.planes[k], np.uint8)[block * BLOCK // 8 : (i + 7) // 8]
        inside = np.unpackbits(tail, count=i - block * BLOCK, bitorder="little").sum()
        return int(np.frombuffer(self.ranks[k], "<u4")[block]) + int(inside)

    def select(self, k: int, bit: int, j: int) -> int:
        """The place of the ``j``-th (from 0) bit of plane ``k`` that equals ``bit``."""
        ones = np.frombuffer(self.ranks[k], "<u4").astype(np.int64)
        counts = ones if bit else np.minimum(np.arange(len(ones)) * BLOCK, self.n) - ones
        block = int(np.searchsorted(counts, j, side="right")) - 1
        bits = np.unpackbits(np.frombuffer(self.planes[k], np.uint8)[block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == bit)[j - int(counts[block])])

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k, zeros in enumerate(self.zeros):
            bit = self.planes[k][i // 8] >> (i % 8) & 1
            ones = self.rank(k, i)
            i = zeros + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        depth = len(self.zeros)
        if token < 0 or token >> depth:
            return 0, 0
        for k, zeros in enumerate(self.zeros):
            a, b = self.rank(k, start), self.rank(k, end)
            start, end = (zeros + a, zeros + b) if token >> (depth - 1 - k) & 1 else (start - a, end - b)
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often ``token`` occurs from place ``start`` up to ``end``."""
        a, b = self._range(token, start, self.n if end is None else end)
        return b - a

    def occurrence(self, token: int, j: int) -> int:
        """The place of the ``j``-th (from 0) occurrence of ``token``."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= j < b - a:
            raise IndexError(j)
        i = a + j
        for k in range(len(self.zeros) - 1, -1, -1):
            bit = token >> (len(self.zeros) - 1 - k) & 1
            i = self.select(k, bit, i - self.zeros[k] if bit else i)
        return i

    def ids(self) -> np.ndarray:
        """All ids in their order: each plane's sorting is undone, from the lowest plane up."""
        out = np.zeros(self.n, np.uint32)
        for k in range(len(self.zeros) - 1, -1, -1):
            bits, zeros = self._bits(k), self.zeros[k]
            above = np.empty(self.n, np.uint32)
            above[~bits] = out[:zeros]
            above[bits] = out[zeros:] | np.uint32(1 << (len(self.zeros) - 1 - k))
            out = above
        return out


def groups_of(texts: Iterator[tuple[int, str]]) -> Iterator[tuple[list[int], list[str]]]:
    """Row numbers and texts in groups of about ``GROUP_CHARS`` characters, to be encoded together."""
    rows: list[int] = []
    group: list[str] = []
    chars = 0
    for k, text in texts:
        rows.append(k)
        group.append(text)
        chars += len(text)
        if chars >= GROUP_CHARS:
            yield rows, group
            rows, group, chars = [], [], 0
    if rows:
        yield rows, group


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int, id_column: str = "doc_id", text_column: str = "text", shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode every text, append ``end_id`` and write the ids in ascending order of document id.

    A null text is empty and has the end id alone. Rows that repeat an id follow each other in the order
    of a hash of their texts; a null id comes first. An empty table makes a folder without shards.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.coalesce(text_column, F.lit("")).alias("_text"))
    tie = F.xxhash64("_text")
    dealt = rows.repartitionByRange(partitions(spark), F.col("_id"), tie).sortWithinPartitions("_id", tie)
    dealt = dealt.select("_id", "_text", F.spark_partition_id().alias("_part"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path)
        depth = max(int(encoder.size - 1), end_id).bit_length()
        held: list[np.ndarray] = []
        ids: list[int | None] = []
        before = tokens = 0
        part = 0

        def shard() -> pa.RecordBatch:
            nonlocal before, tokens
            matrix = WaveletMatrix.build(np.concatenate(held), depth)
            row = {"part": part, "before": before, "n_tokens": matrix.n, "doc_ids": ids, "lengths": [len(h) for h in held], "zeros": matrix.zeros, "planes": matrix.planes, "ranks": matrix.ranks}
            types = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.list_(pa.binary())]
            out = pa.record_batch([pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], list(row))
            before, tokens = before + matrix.n, 0
            held.clear()
            ids.clear()
            return out

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for rows, texts in groups_of(texts_of(batch, 1)):
                for k, found in zip(rows, encoder.ids_of_all(texts), strict=True):
                    part = batch.column(2)[k].as_py()
                    held.append(np.append(found, np.uint32(end_id)).astype(np.uint16 if depth <= 16 else np.uint32))
                    ids.append(doc_ids[k])
                    tokens += len(held[-1])
                    if tokens >= shard_tokens:
                        yield shard()
        if held:
            yield shard()

    dealt.mapInArrow(encode, SHARD).write.option("compression", "zstd").option("parquet.block.size", 32 << 20).parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shards, with ``start``: the ids in all shards before each one.

    What is sent to the tasks has one row per written file.
    """
    shards = spark.read.schema(SHARD).parquet(folder)
    sizes = shards.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    return shards.join(F.broadcast(offsets), "part").withColumn("start", F.col("_offset") + F.col("before")).drop("_offset")


def matrix_of(row: dict) -> WaveletMatrix:
    return WaveletMatrix(row["n_tokens"], row["zeros"], row["planes"], row["ranks"])


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, unpacked from the shards."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                ids = matrix_of(row).ids().astype("<u4")
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                crc = [zlib.crc32(ids[a:b].data) for a, b in zip(starts, ends, strict=True)]
                out = [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["start"], pa.int64()), pa.array(row["lengths"], pa.int64()), pa.array(crc, pa.int64())]
                yield pa.record_batch(out, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_shards(spark, folder).mapInArrow(unpack, "doc_id long, start long, n_tokens long, ids_crc32 long")


def count_token(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """``start, occurrences``: how often each shard has ``token``, by rank alone."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.record_batch([pa.array([r["start"] for r in rows], pa.int64()), pa.array([matrix_of(r).count(token) for r in rows], pa.int64())], ["start", "occurrences"])

    return read_shards(spark, folder).mapInArrow(count, "start long, occurrences long")


def find_token(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """``place``: where ``token`` is in the sequence of all ids, by select."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                matrix = matrix_of(r)
                places = [r["start"] + matrix.occurrence(token, j) for j in range(matrix.count(token))]
                yield pa.record_batch([pa.array(places, pa.int64())], ["place"])

    return read_shards(spark, folder).mapInArrow(find, "place long")
