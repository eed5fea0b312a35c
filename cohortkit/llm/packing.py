"""Best-fit packing of documents into sequences of a fixed length.

Documents become token pieces, sorted into classes by length. A round takes one
class, longest first: a sweep over the gaps gives its pieces the smallest gap
that holds them, rank against rank, so no two pieces claim the same gap; the
gaps shrink, and the sweep goes on until no gap is left that fits. Then new
sequences open, as many as the rest of the class needs by itself. Pieces of a
class are alike, so a round needs only their number and the runs of sequences
with equal gaps: the driver holds at most ``capacity`` counts, and the rounds
become a table of rank intervals whose size depends on ``capacity`` and not on
the number of documents. Every task then looks its pieces up by class and rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.text import slices
from cohortkit.llm.tokens import default_vocabulary, encoder
from cohortkit.session import materialise

CAPACITY = 2048
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"


def _cut(path: str, capacity: int, end: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for whole in batches:
            for batch in slices(whole, "text"):
                ids, at = coder.encode(batch.column("text").cast(pa.string()))
                counts = np.diff(at) + 1
                pieces = -(-counts // capacity)
                row = np.repeat(np.arange(len(counts)), pieces)
                number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = counts - (pieces - 1) * capacity
                start = np.where(number == 0, 0, head[row] + (number - 1) * capacity)
                length = np.where(number == 0, head[row], capacity)
                checks = np.empty(len(row), np.int64)
                last = (number == pieces[row] - 1).tolist()
                low = (at[row] + start).tolist()
                high = (at[row] + start + length).tolist()
                tail = np.array([end], "<u4").tobytes()
                wide = ids.astype("<u4")
                for i, (a, b, closing) in enumerate(zip(low, high, last, strict=True)):
                    checks[i] = zlib.crc32(tail, zlib.crc32(wide[a : b - 1])) if closing else zlib.crc32(wide[a:b])
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                place = np.empty(len(row), np.int64)
                place[order] = seen[ordered] + np.arange(len(row)) - np.searchsorted(ordered, ordered)
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row)), pa.array(number, pa.int32()), pa.array(start), pa.array(length),
                     pa.array(checks), pa.array(np.full(len(row), part), pa.int32()), pa.array(place)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"],
                )

    return cut


def rounds(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit rounds over pieces counted by length.

    Rows (length, first rank, number, first sequence, offset): pieces of that
    length with these ranks go to consecutive sequences at the offset.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    plan, opened = [], 0
    for length in sorted(counts, reverse=True):
        left, rank, gap = counts[length], 0, length
        while left:
            while gap < capacity and gap not in gaps:
                gap += 1
            if gap >= capacity:
                new = -(-left // (capacity // length))
                gaps.setdefault(capacity, []).append((opened, new))
                opened += new
                gap = capacity
            runs = gaps.pop(gap)
            while runs and left:
                first, number = runs.pop()
                taken = min(number, left)
                plan.append((length, rank, taken, first, capacity - gap))
                if taken < number:
                    runs.append((first + taken, number - taken))
                if gap > length:
                    gaps.setdefault(gap - length, []).append((first, taken))
                left, rank = left - taken, rank + taken
            if runs:
                gaps[gap] = runs
            gap = length
    return np.array(sorted(plan), np.int64).reshape(-1, 5)


def _placed(plan: np.ndarray):
    keys = (plan[:, 0] << 44) + plan[:, 1]

    def place(frames):
        for frame in frames:
            rank = frame.pop("rank").to_numpy()
            at = np.searchsorted(keys, (frame["length"].to_numpy() << 44) + rank, "right") - 1
            frame["sequence_id"] = plan[at, 3] + rank - plan[at, 1]
            frame["offset"] = plan[at, 4]
            yield frame

    return place


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, end: int = 0) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    A document is its ids and then ``end``. Only longer ones are cut, into
    pieces of ``capacity`` tokens; the first piece takes the remainder. Returns
    one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. A null or empty text is the one token ``end``; null or repeated ids
    are packed row by row; an empty table gives no rows; other columns are left
    out.
    """
    vocabulary = vocabulary or default_vocabulary()
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = materialise(chosen.mapInArrow(_cut(vocabulary, capacity, end), _PIECES), "pieces")
    per_part = materialise(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("rank"))
    return ranked.mapInPandas(
        _placed(rounds(counts, capacity)),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
