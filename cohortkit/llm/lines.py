"""Lines that many documents repeat, removed from all of them but one.

Lines are exploded and normalised, and only a hash of 128 bits of each long enough line
travels, with its place. Distinct documents are counted per hash; lines of hashes over the
threshold go, and each text is put together again from the lines that stay, by position.
A line that stands in a third of all documents is counted before it is shuffled
and looked up in a broadcast list, as only few hashes can be so frequent.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.text import slices
from cohortkit.session import broadcast_if_small, materialise

BLANKS = b" \t\n\x0b\x0c\r"
# A hash with more than this share of all lines is hot; there are fewer than 4,096 of them.
_HOT = 4096


def line_key(line: bytes, least_chars: int) -> bytes | None:
    """The line without blanks at its ends, if it has at least so many characters; A-Z must be lower-cased before."""
    key = line.strip(BLANKS)
    if len(key) < least_chars or (not key.isascii() and len(key.decode("utf-8", "replace")) < least_chars):
        return None
    return key


def _explode(least_chars: int):
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                row, place, digests = [], [], []
                for number, text in enumerate(batch.column("text").cast(pa.large_binary()).to_pylist()):
                    for i, line in enumerate(text.lower().split(b"\n")):  # bytes: only A-Z change
                        key = line_key(line, least_chars)
                        if key is not None:
                            row.append(number)
                            place.append(i)
                            digests.append(blake2b(key, digest_size=16).digest())
                rows = pa.array(row, pa.int64())
                halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows), batch.column("print").take(rows), pa.array(place, pa.int32()),
                     pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())],
                    names=["doc_id", "print", "place", "high", "low"])

    return explode


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines that stay, in their order."""
    for whole in batches:
        for batch in slices(whole, "text"):
            kept, lines, dropped = [], [], []
            for text, gone in zip(batch.column("text").cast(pa.large_binary()).to_pylist(), batch.column("gone").to_pylist(), strict=True):
                lines.append(text.count(b"\n") + 1)
                dropped.append(len(gone or ()))
                if gone:
                    out = set(gone)
                    text = b"\n".join(line for i, line in enumerate(text.split(b"\n")) if i not in out)
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                names=["doc_id", "text", "n_lines", "n_dropped"])


def drop_repeated_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """``docs`` (doc_id, text) without the lines that at least ``least_docs`` documents hold.

    Returns doc_id, text, n_lines (before), n_dropped. Lines lie between line feeds; they are equal
    if they are so without blanks at their ends and with A-Z in lower case. Lines of fewer than
    ``least_chars`` characters stay. A repeated line stays, wherever it stands, in the largest doc_id
    that holds it. A null text is an empty one: one empty line. Rows that share an id are one
    document for the counts; a row without an id counts nowhere and stays whole; a
    text whose lines all go becomes empty; other columns are left out; an empty table gives no rows.
    """
    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("print", F.xxhash64("text"))
    lines = materialise(
        chosen.where("doc_id is not null").mapInArrow(_explode(least_chars), "doc_id long, print long, place int, high long, low long"), "lines")
    key = ["high", "low"]
    # Counted in two steps, by (hash, document) and by hash, both combined before they are shuffled.
    common = materialise(
        lines.groupBy(*key).agg(F.count_distinct("doc_id").alias("docs"), F.count("*").alias("rows"), F.max("doc_id").alias("keep")).where(
            F.col("docs") >= least_docs).select(*key, "rows", "keep"), "common-lines")
    bound = lines.count() // _HOT
    hot = F.broadcast(common.where(F.col("rows") > bound).select(*key, "keep"))
    other = common.where(F.col("rows") <= bound).select(*key, "keep")
    cold = lines.join(hot, key, "left_anti").join(other, key)
    gone = lines.join(hot, key).unionByName(cold).where("doc_id <> keep").groupBy("doc_id", "print").agg(
        F.collect_set("place").alias("gone"))
    # Equal rows (id and text) lose the same lines, so the id and a hash of the text find them.
    return chosen.join(broadcast_if_small(gone), ["doc_id", "print"], "left").select("doc_id", "text", "gone").mapInArrow(
        _assemble, "doc_id long, text string, n_lines long, n_dropped long")
