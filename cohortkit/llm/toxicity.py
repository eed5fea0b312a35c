"""Toxicity by logistic regression over hashed word n-grams, trained by FTRL-proximal.

Features are the distinct words, word pairs and pairs with one or two words
skipped, hashed into a fixed number of coordinates. FTRL-proximal keeps a rate
per coordinate and an L1 threshold, so that most weights are exactly zero and
the rest go to the tasks as two small arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.text import LETTERS, Words, mix, slices
from cohortkit.session import materialise

#: Most labelled rows that the fit reads, those with the smallest hash of the id.
FIT_ROWS = 20_000
BITS = 20


def features(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, coordinate) of every word, pair and skip-pair; repeats are not removed."""
    words = Words(texts, LETTERS)
    h = words.hashes()
    rows, found = [words.row], [h]
    for gap in (1, 2, 3):
        same = words.row[gap:] == words.row[:-gap] if len(h) > gap else np.zeros(0, bool)
        pair = mix(h[:-gap] * np.uint64(2 * gap + 1) + (h[gap:] >> np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(gap)) if len(h) > gap else h[:0]
        rows.append(words.row[gap:][same] if len(h) > gap else words.row[:0])
        found.append(pair[same])
    coordinate = (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)
    return np.concatenate(rows), coordinate


@dataclass(frozen=True)
class Weights:
    """Coordinates with a weight, their weights, and the intercept."""

    at: np.ndarray
    value: np.ndarray
    bias: float
    bits: int


class Ftrl:
    """The sums that FTRL-proximal keeps for each coordinate, and nothing about the rows it has seen."""

    def __init__(self, bits: int, alpha: float, beta: float, l1: float, l2: float, toxic_weight: float):
        self.bits, self.alpha, self.beta, self.l1, self.l2, self.toxic_weight = bits, alpha, beta, l1, l2, toxic_weight
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)
        self.bias, self.bias_n = 0.0, 0.0

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) > self.l1, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2), 0.0)

    def learn(self, at: np.ndarray, toxic: int) -> None:
        """One step with the distinct coordinates of a row and its label."""
        z, n = self.z[at], self.n[at]
        w = self._weights(z, n)
        g = 1 / (1 + np.exp(-np.clip(self.bias + w.sum(), -30, 30))) - toxic
        g *= self.toxic_weight if toxic else 1
        self.z[at] = z + g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g
        self.bias_n += g * g
        self.bias -= self.alpha * g / (self.beta + np.sqrt(self.bias_n))

    def weights(self) -> Weights:
        w = self._weights(self.z, self.n)
        at = np.flatnonzero(w)
        return Weights(at, w[at], self.bias, self.bits)


def _examples(bits: int):
    def examples(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                row, at = features(batch.column("text"), bits)
                pairs = np.unique((row << bits) | at)
                bounds = np.searchsorted(pairs >> bits, np.arange(batch.num_rows + 1)) * 4
                packed = (pairs & ((1 << bits) - 1)).astype("<i4")
                at = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(packed)])
                yield pa.RecordBatch.from_arrays([batch.column("toxic"), at], names=["toxic", "at"])

    return examples


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, bits: int = BITS, epochs: int = 2) -> DataFrame:
    """epoch, toxic and ``at`` (the distinct coordinates as 32-bit integers) of each labelled row and epoch, in training order.

    Features are computed where the texts lie and written once. Each epoch has its own order, by a
    hash of the row's content; the order is an external sort, so no task holds more than a batch of rows.
    """
    clean = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(
        F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other")
    chosen = clean.select("doc_id", F.col("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # At most ``rows`` pairs of numbers: a proven bound for the broadcast.
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    stored = materialise(sample.select("toxic", "text").mapInArrow(_examples(bits), "toxic int, at binary"), "toxicity-rows")
    order = stored.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))).withColumn("turn", F.xxhash64("at", "toxic", "epoch"))
    # The steps of FTRL depend on each other, so one task takes the (boundedly many) rows in turn.
    return order.repartition(1).sortWithinPartitions("epoch", "turn", "toxic", "at").select("epoch", "toxic", "at")


def fit(
    docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, bits: int = BITS, epochs: int = 2,
    alpha: float = 1.0, beta: float = 1.0, l1: float = 6.0, l2: float = 1.0, toxic_weight: float = 2.0,
) -> Weights:
    """Fit from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic 0 or 1).

    Reads at most ``rows`` labelled documents, by the smallest hash of the id.
    Ids labelled both ways, null ids and other label values do not count. With no
    labelled document every score is sigmoid(-3). ``toxic_weight`` scales the steps of toxic rows.
    Rows that share an id are examples of their own; equal rows are taken one after the other. Memory is
    that of a batch of rows and two numbers a coordinate, however long the texts.
    """
    def learn(batches):
        model, seen = Ftrl(bits, alpha, beta, l1, l2, toxic_weight), 0
        for batch in batches:
            for toxic, at in zip(batch.column("toxic").to_pylist(), batch.column("at"), strict=True):
                model.learn(np.frombuffer(at.as_buffer(), "<i4"), toxic)
            seen += batch.num_rows
        if seen:
            w = model.weights()
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.at.astype("<i8").tobytes()], pa.binary()), pa.array([w.value.astype("<f8").tobytes()], pa.binary()), pa.array([w.bias])],
                names=["at", "value", "bias"])

    ordered = training_rows(docs, labels, rows, bits, epochs)
    got = ordered.select("toxic", "at").mapInArrow(learn, "at binary, value binary, bias double").collect()
    if not got:
        return Weights(np.zeros(0, np.int64), np.zeros(0), -3.0, bits)
    return Weights(np.frombuffer(got[0]["at"], "<i8"), np.frombuffer(got[0]["value"], "<f8"), got[0]["bias"], bits)


def score(docs: DataFrame, weights: Weights) -> DataFrame:
    """``docs`` (text) with a column ``toxicity`` between 0 and 1, whole texts; a null text scores like an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    columns = [c for c in docs.columns if c != "toxicity"]
    chosen = docs.select(*columns)

    def scored(batches):
        w = shared.value
        table = np.zeros(1 << w.bits)
        table[w.at] = w.value
        for whole in batches:
            for batch in slices(whole, "text"):
                row, at = features(batch.column("text"), w.bits)
                used = table[at] != 0
                pairs = np.unique((row[used] << w.bits) | at[used])
                total = np.bincount(pairs >> w.bits, table[pairs & ((1 << w.bits) - 1)], batch.num_rows) + w.bias
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(total, -30, 30))))], names=[*columns, "toxicity"])

    from pyspark.sql.types import DoubleType, StructType

    return chosen.mapInArrow(scored, StructType([*chosen.schema.fields]).add("toxicity", DoubleType()))
