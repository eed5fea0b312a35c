"""Exact ranked lexical search of all documents for a set of items, by classes of equal bags.

Only the terms of the items can score, so each document is restricted to them: a vector of
(term, occurrences) and ``m``, the length norm. Documents with equal vectors and equal
``m`` score alike for every item; they form a class, found by a hash and verified by the
vector itself. A class is scored once, and because its members tie and ties go to the
smaller doc_id, its ``k`` smallest ids are all that a ranking can take from it.
The items come in blocks of bounded text; each task keeps the ``k`` best of each item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.text import LETTERS, Words, runs, slices
from cohortkit.llm.vocabulary import encode, places
from cohortkit.session import materialise

#: Bytes of item text in a block: what a task receives is a few times that, or one longer item.
BLOCK_BYTES = 4 << 20
# Cells (item, class) and listings (class, term, item) that a task scores at a time.
_CELLS = 1 << 21
_NO_ID = np.iinfo(np.int64).max
_BAGS = "doc_id long, n long, size int, bag binary, term int, docs long"


@dataclass(frozen=True)
class Block:
    """Items of a block: their row numbers, the distinct terms, and each term's (item, occurrences) list."""

    rows: np.ndarray
    terms: pa.Array
    first: np.ndarray
    item: np.ndarray
    often: np.ndarray


def _block(rows: list[int], texts: list[str | None]) -> Block:
    words = Words(pa.array(texts, pa.string()), LETTERS)
    distinct, code = encode(words)
    key, often = np.unique(code * max(1, len(rows)) + words.row, return_counts=True)
    term = key // max(1, len(rows))
    return Block(np.array(rows, np.int64), distinct, np.searchsorted(term, np.arange(len(distinct) + 1)), key % max(1, len(rows)), often)


def _blocks(items: DataFrame, most: int) -> Iterator[Block]:
    rows, texts, held = [], [], 0
    for r in items.select("row", "text").toLocalIterator():
        size = len((r["text"] or "").encode())
        if rows and held + size > most:
            yield _block(rows, texts)
            rows, texts, held = [], [], 0
        rows.append(r["row"])
        texts.append(r["text"])
        held += size
    if rows:
        yield _block(rows, texts)


def pack_bags(row: np.ndarray, term: np.ndarray, often: np.ndarray, rows: int, wide: bool) -> tuple[list[bytes], np.ndarray]:
    """A byte string for the sorted terms of each row: terms, then counts of a byte, then counts of 255 and more in full."""
    bounds = np.searchsorted(row, np.arange(rows + 1))
    terms = term.astype("<u4" if wide else "<u2").tobytes()
    small = np.minimum(often, 255).astype(np.uint8).tobytes()
    large = often >= 255
    over = np.concatenate([[0], np.cumsum(large)])[bounds].tolist()
    rest = often[large].astype("<u8").tobytes()
    each = 4 if wide else 2
    ends = bounds.tolist()
    bags = [
        terms[each * a : each * b] + small[a:b] + (rest[8 * x : 8 * y] if x < y else b"")
        for a, b, x, y in zip(ends[:-1], ends[1:], over[:-1], over[1:], strict=True)]
    return bags, np.diff(bounds)


def unpack_bags(bags: list[bytes], sizes: np.ndarray, wide: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and occurrences, as they were packed."""
    each = 4 if wide else 2
    cut = sizes.tolist()
    term = np.frombuffer(b"".join(b[: each * n] for b, n in zip(bags, cut, strict=True)), "<u4" if wide else "<u2").astype(np.int64)
    often = np.frombuffer(b"".join(b[each * n : (each + 1) * n] for b, n in zip(bags, cut, strict=True)), np.uint8).astype(np.int64)
    large = often == 255
    if large.any():
        often[large] = np.frombuffer(b"".join(b[(each + 1) * n :] for b, n in zip(bags, cut, strict=True)), "<u8")
    return np.repeat(np.arange(len(cut)), sizes), term, often


def _restrict(shared, wide: bool):
    """Each document's bag over the block's terms, and per task how many documents hold each term."""

    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value.terms
        holding = np.zeros(len(terms), np.int64)
        for whole in batches:
            for batch in slices(whole, "text"):
                words = Words(batch.column("text"), LETTERS)
                distinct, code = encode(words)
                at = places(distinct, terms)[code]
                key, often = np.unique((words.row * len(terms) + at)[at >= 0], return_counts=True)
                row, term = key // max(1, len(terms)), key % max(1, len(terms))
                holding += np.bincount(term, minlength=len(terms))
                bags, size = pack_bags(row, term, often, batch.num_rows, wide)
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(words.counts.astype(np.int64)), pa.array(size.astype(np.int32)),
                     pa.array(bags, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())],
                    names=["doc_id", "n", "size", "bag", "term", "docs"])
        held = np.flatnonzero(holding)
        n = len(held)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
             pa.array(held.astype(np.int32)), pa.array(holding[held])],
            names=["doc_id", "n", "size", "bag", "term", "docs"])

    return restrict


def _sums(cell: np.ndarray, value: np.ndarray, cells: int) -> np.ndarray:
    """Exact 64-bit sums of whole numbers by cell; each half of a number stays exact in doubles."""
    high = np.bincount(cell, (value >> 26).astype(float), cells).astype(np.int64)
    return (high << 26) + np.bincount(cell, (value & ((1 << 26) - 1)).astype(float), cells).astype(np.int64)


class _Best:
    """The ``k`` best classes of each item so far: by score, then by smallest id."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.item, self.score, self.lowest = (np.zeros(0, np.int64) for _ in range(3))
        self.members: list = []

    def add(self, scores: np.ndarray, lowest: np.ndarray, members: list) -> None:
        found = scores >= self.least[:, None]
        if scores.shape[1] > self.k and np.count_nonzero(found) > 4 * self.k * len(scores):
            edge = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k]
            found = scores >= np.maximum(self.least, edge)[:, None]
        item, column = np.nonzero(found)
        item, score, low = (np.concatenate(x) for x in ((self.item, item), (self.score, scores[item, column]), (self.lowest, lowest[column])))
        source = np.concatenate([np.arange(len(self.members)), len(self.members) + column])
        order = np.lexsort((low, -score, item))
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        order = order[place < self.k]
        place = place[place < self.k]
        self.item, self.score, self.lowest = item[order], score[order], low[order]
        held = len(self.members)
        self.members = [self.members[i] if i < held else members[i - held] for i in source[order].tolist()]
        full = place == self.k - 1
        self.least[self.item[full]] = self.score[full]

    def ranked(self) -> tuple[list, list, list]:
        """Item, score and doc_id of the best documents."""
        item, score, doc = [], [], []
        for i, s, ids in zip(self.item.tolist(), self.score.tolist(), self.members, strict=True):
            for one in ids:
                item.append(i)
                score.append(s)
                doc.append(one)
        return item, score, doc


def _score(shared, wide: bool, k: int):
    """The best documents of each item among the classes of a task."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weight = shared.value
        items, lists = len(block.rows), np.diff(block.first)
        best = _Best(items, k)
        for batch in batches:
            row, term, often = unpack_bags(batch.column("bag").to_pylist(), batch.column("size").to_numpy(), wide)
            m = batch.column("m").to_numpy()
            value = weight[term] * ((1_000_000_000 * often) // (1000 * often + 8 * m[row]))
            members = batch.column("members").to_pylist()
            ids = [[x["doc_id"] for x in sorted(ms, key=lambda x: x["place"])] for ms in members]
            lowest = np.array([_NO_ID if x[0] is None else x[0] for x in ids], np.int64)
            reach = np.cumsum(lists[term])  # listings up to each entry
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
            at = 0
            while at < batch.num_rows:
                begin = reach[bounds[at] - 1] if bounds[at] else 0
                upto = np.searchsorted(np.concatenate([[0], reach])[bounds], begin + _CELLS, "right") - 1
                end = min(batch.num_rows, max(at + 1, min(int(upto), at + _CELLS // max(1, items))))
                some = slice(bounds[at], bounds[end])
                listed = runs(block.first[term[some]], lists[term[some]])
                of = np.repeat(np.arange(bounds[at], bounds[end]), lists[term[some]])
                cell = block.item[listed] * (end - at) + row[of] - at
                scores = _sums(cell, value[of] * block.often[listed], items * (end - at)).reshape(items, end - at)
                best.add(scores, lowest[at:end], ids[at:end])
                at = end
        item, value, doc = best.ranked()
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.rows[np.array(item, np.int64)]), pa.array(value, pa.int64()), pa.array(doc, pa.int64())],
            names=["row", "score", "doc_id"])

    return score


def search(docs: DataFrame, items: DataFrame, k: int = 10, b: int = 75, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` best of ``docs`` (doc_id, text) for each of ``items`` (item_id, text): item_id, rank, doc_id, score.

    Terms are runs of letters, digits and everything beyond ASCII, A-Z in lower case. With N
    documents that hold a term, L terms in them, and n terms in a document, its norm m is
    100 - ``b`` + (``b`` n N) div L. A term held by df documents weighs floor(1000 ln((2N + 2) / (2df + 1)));
    each of its occurrences in the item adds the weight times (10^9 tf) div (1000 tf + 8 m). Only
    scores above 0 count; ties go to the smaller doc_id, a null id last. Every row of ``docs`` is
    a document, so rows of one id are listed each; every row of ``items`` is an item, ranked for itself,
    also with a null or repeated id. Null and empty texts hold no terms and are not found or find
    nothing. Other columns are left out; empty tables give no rows.
    """
    spark = docs.sparkSession
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = materialise(
        items.select("item_id", F.col("text").cast("string").alias("text")).withColumn("row", F.monotonically_increasing_id()), "items")
    found = None
    for block in _blocks(asked, block_bytes):
        if not len(block.terms):
            continue
        part = _search_block(chosen, block, k, b)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "row long, score long, doc_id long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")


def _search_block(chosen: DataFrame, block: Block, k: int, b: int) -> DataFrame:
    spark, wide = chosen.sparkSession, len(block.terms) > 1 << 16
    # A block holds bounded text, so its terms, their weights and their lists are bounded too.
    bags = materialise(chosen.mapInArrow(_restrict(spark.sparkContext.broadcast(block), wide), _BAGS), "bags")
    total = bags.where("n > 0").agg(F.count("*").alias("n"), F.sum("n").alias("terms")).first()
    weight = np.zeros(len(block.terms), np.int64)
    for r in bags.where("term is not null").groupBy("term").agg(F.sum("docs").alias("docs")).collect():
        weight[r["term"]] = math.floor(1000 * math.log((2 * total["n"] + 2) / (2 * r["docs"] + 1)))
    # Decimals, as the product of a long text's length and the number of documents may pass 64 bits.
    m = F.expr(
        f"{100 - b} + (cast({b} * n as decimal(20, 0)) * cast({total['n']} as decimal(18, 0))) div cast({max(1, total['terms'] or 0)} as decimal(20, 0))")
    held = bags.where("size > 0").select("doc_id", m.cast("long").alias("m"), "size", "bag").withColumn("print", F.xxhash64("m", "bag"))
    # The hash deals and sorts the classes; the vector itself is part of the key and verifies them.
    key = ["print", "m", "size", "bag"]
    order = Window.partitionBy(*key).orderBy(F.asc_nulls_last("doc_id"))
    members = held.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    classes = members.groupBy(*key).agg(F.collect_list(F.struct("place", "doc_id")).alias("members"))
    shared = spark.sparkContext.broadcast((block, weight))
    return classes.select("m", "size", "bag", "members").mapInArrow(_score(shared, wide, k), "row long, score long, doc_id long")
