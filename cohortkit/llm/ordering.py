"""Token sequences written in training order as fixed-stride binary shards.

A first pass counts the sequences of each input partition; a keyed Feistel
permutation with cycle-walking maps the running number of a sequence to its
global slot, so no table of random numbers is kept or sorted. The second pass
sends each sequence to the shard that covers its slot. A shard holds ``per_shard``
records of equal size in slot order: two little-endian bytes a token, and
one closing byte, because Spark's text writer (which commits whole tasks on any
file system) ends each record with a separator. Slot s therefore lies in shard
s // per_shard at byte (s % per_shard) * stride.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.text import mix, slices
from cohortkit.llm.tokens import default_vocabulary, encoder

END = 50256


def permuted(index: np.ndarray, size: int, key: int, rounds: int = 6) -> np.ndarray:
    """Slots of ``index`` (numbers below ``size``) under the keyed permutation of range(size)."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) + np.uint64(key & (2**64 - 1)))

    def feistel(x):
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        return (left << np.uint64(half)) | right

    out = feistel(index.astype(np.uint64))
    while (outside := out >= np.uint64(size)).any():
        out[outside] = feistel(out[outside])
    return out.astype(np.int64)


@dataclass(frozen=True)
class Shards:
    """Where the shards are and how to address them."""

    path: str
    sequences: int
    length: int
    per_shard: int

    @property
    def stride(self) -> int:
        return 2 * self.length + 1

    def files(self, spark: SparkSession, first_slot: int = 0) -> DataFrame:
        """Shard number and bytes of every shard from the one with ``first_slot`` on; earlier ones are not opened."""
        shard = first_slot // self.per_shard
        return spark.read.format("binaryFile").load(self.path).where(F.col("shard") >= shard).select(
            F.col("shard").cast("long").alias("shard"), "content")

    def records(self, spark: SparkSession, first_slot: int = 0) -> DataFrame:
        """Slot, ids (little-endian pairs of bytes) and crc32 of each sequence, read back from the shards."""
        length, stride, per_shard = self.length, self.stride, self.per_shard

        def read(batches):
            for batch in batches:
                for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    raw = np.frombuffer(content.as_buffer(), np.uint8)
                    if len(raw) % stride:
                        raise ValueError(f"shard {shard} is cut off")
                    rows = raw.reshape(-1, stride)[:, : 2 * length]
                    slots = shard * per_shard + np.arange(len(rows))
                    rows, slots = rows[slots >= first_slot], slots[slots >= first_slot]
                    for low in range(0, len(rows), 256):
                        part = [x.tobytes() for x in rows[low : low + 256]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(slots[low : low + 256]), pa.array(part, pa.binary()), pa.array([zlib.crc32(x) for x in part], pa.int64())],
                            names=["slot", "ids", "ids_crc32"])

        return self.files(spark, first_slot).mapInArrow(read, "slot long, ids binary, ids_crc32 long")


def _count(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, tokens, rows = encoder(path), 0, 0
        for whole in batches:
            for batch in slices(whole, "text"):
                tokens += int(coder.counts(batch.column(0).cast(pa.string())).sum()) + batch.num_rows
                rows += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([tokens], pa.int64())], names=["part", "tokens"])

    return count


def _sequences(path: str, length: int, tokens: dict[int, int], first: dict[int, int], size: int, key: int, per_shard: int):
    def emit(records: np.ndarray, number: int) -> pa.RecordBatch:
        slots = permuted(number + np.arange(len(records)), size, key)
        return pa.RecordBatch.from_arrays(
            [pa.array(slots // per_shard), pa.array(slots), pa.array([x.tobytes() for x in records], pa.binary())],
            names=["shard", "slot", "record"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        coder, left, number, seen = encoder(path), np.zeros(0, "<u2"), first.get(part, 0), 0
        for whole in batches:
            for batch in slices(whole, "text", 8 << 20):
                ids, at = coder.encode(batch.column(0).cast(pa.string()))
                stream = np.concatenate([left, np.insert(ids, at[1:], END).astype("<u2")])
                seen += len(stream) - len(left)
                full = len(stream) // length * length
                if full:
                    yield emit(stream[:full].reshape(-1, length), number)
                number, left = number + full // length, stream[full:]
        if len(left):
            padded = np.full(length, END, "<u2")
            padded[: len(left)] = left
            yield emit(padded.reshape(1, -1), number)
        if seen != tokens.get(part, 0):
            raise ValueError(f"partition {part} held {tokens.get(part, 0)} tokens when counted and {seen} now")

    return cut


def write_training_order(
    docs: DataFrame, path: str, length: int = 2048, key: int = 20240229, per_shard: int = 2048, vocabulary: str | None = None
) -> Shards:
    """Write the sequences of ``docs`` (text) to ``path`` in keyed random order.

    The texts of an input partition form one stream, each ended by ``END``, cut
    into sequences of ``length`` ids; its last one is padded with ``END``. A null
    text counts as empty; an empty table writes no shard; other columns do
    not matter. The same rows, key and partitioning give the same files, and
    a table that changes between the two passes raises an error.
    """
    vocabulary = vocabulary or default_vocabulary()
    texts = docs.select(F.col("text").cast("string").alias("text"))
    tokens = {r["part"]: r["tokens"] for r in texts.mapInArrow(_count(vocabulary), "part int, tokens long").collect()}
    first, size = {}, 0
    for part in sorted(tokens):
        first[part] = size
        size += -(-tokens[part] // length)
    shards = Shards(path, size, length, per_shard)
    if size:
        rows = texts.mapInArrow(
            _sequences(vocabulary, length, tokens, first, size, key, per_shard), "shard long, slot long, record binary")
        (
            rows.repartition(-(-size // per_shard), "shard").sortWithinPartitions("shard", "slot")
            .select("shard", F.col("record").cast("string").alias("value"))
            .write.partitionBy("shard").text(path)
        )
    return shards
