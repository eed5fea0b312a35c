"""Benchmark phrases in documents, found in a distributed positional inverted index.

``build_index`` stores the postings of all words of all documents. The index is
cut by document into segments of bounded text; inside a segment the words of all
documents are numbered through, with a gap between documents, and each term has
the sorted list of its numbers. ``find_phrases`` takes, in each segment, the
phrase's terms from the rarest on, shifts each list by the term's offset in the
phrase, and intersects; most phrases end at a term that the segment lacks.
Segments hold bounded text, so a term, source or passage that is everywhere is
spread over as many tasks as there are segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.text import LETTERS, Words, slices
from cohortkit.session import materialise, scratch_path

WINDOW = 10
# Phrases looked up in one pass over the index, a bound on what each task receives.
PHRASES = 200_000
_GAP = 64
_INDEX = "segment string, term long, postings binary, doc_id long, doc_row long, first long, n_words long"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    for whole in batches:
        for batch in slices(whole, "text"):
            words = Words(batch.column("text"), LETTERS)
            first = np.cumsum(words.counts + _GAP) - (words.counts + _GAP)
            place = (np.arange(len(words.starts)) - np.repeat(words.first[:-1], words.counts) + np.repeat(first, words.counts)).astype("<u4")
            terms = words.hashes().view(np.int64)
            order = np.argsort(terms, kind="stable")
            terms, place = terms[order], place[order]
            # Each list as its first number and then differences, which compress well.
            heads = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.zeros(0, np.int64)
            steps = np.diff(place, prepend=place[:1])
            steps[heads] = place[heads]
            bounds = np.concatenate([heads, [len(terms)]]).astype(np.int32) * 4
            blob = pa.Array.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(steps.astype("<u4"))])
            segment, docs = f"{part}-{number}", batch.num_rows
            number += 1
            nothing = pa.nulls(len(heads), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment] * len(heads), pa.string()), pa.array(terms[heads]), blob, nothing, nothing, nothing, nothing],
                names=["segment", "term", "postings", "doc_id", "doc_row", "first", "n_words"])
            rows = np.arange(docs) + (part << 40) + (number << 24)
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment] * docs, pa.string()), pa.nulls(docs, pa.int64()), pa.nulls(docs, pa.binary()),
                 batch.column("doc_id"), pa.array(rows), pa.array(first), pa.array(words.counts)],
                names=["segment", "term", "postings", "doc_id", "doc_row", "first", "n_words"])


def build_index(docs: DataFrame) -> DataFrame:
    """Stored index of ``docs`` (doc_id, text): rows of terms with postings, and a row per document.

    A null text has no words. Null and repeated ids stay separate rows
    (``doc_row`` tells them apart); other columns are left out.
    """
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    path = scratch_path(docs.sparkSession, "postings")
    chosen.mapInArrow(_index, _INDEX).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(_INDEX).parquet(path)


def phrases(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Windows of ``items`` (item_id, text): item_id and term hashes, ``window`` consecutive words each.

    A shorter item is one window; one without words has none. Repeats of a
    window within an item count once. Rows that share an id are one item with the windows
    of all of them, of whatever lengths; so are rows without an id. Other columns are left out.
    """

    def cut(batches):
        for batch in batches:
            words = Words(batch.column("text"), LETTERS)
            terms = words.hashes().view(np.int64)
            ids, found = [], []
            for item, low, count in zip(batch.column("item_id").to_pylist(), words.first.tolist(), words.counts.tolist(), strict=False):
                windows = {tuple(terms[s : s + window].tolist()) for s in range(low, low + max(1, count - window + 1))} if count else ()
                for one in sorted(x[: count] for x in windows):
                    ids.append(item)
                    found.append(list(one[:count]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(found, pa.list_(pa.int64()))], names=["item_id", "terms"])

    chosen = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(cut, "item_id string, terms array<long>")


def _match(wanted: list[tuple[str | None, np.ndarray]], slop: int):
    """Per segment: the runs of document words that the phrases of each item cover."""

    every = np.concatenate([np.zeros(0, np.int64), *(t for _, t in wanted)])
    heads = np.cumsum([0, *(len(t) for _, t in wanted)])[:-1]

    def near(values, targets):
        at = np.searchsorted(values, targets - slop)
        return (at < len(values)) & (values[np.minimum(at, len(values) - 1)] <= targets + slop)

    def match(frame):
        lists = {t: np.cumsum(np.frombuffer(p, "<u4"), dtype=np.int64) for t, p in zip(frame["term"], frame["postings"], strict=True) if p is not None}
        docs = frame[frame["doc_row"] >= 0].sort_values("first")
        first = docs["first"].to_numpy(np.int64)
        item_of, low, high = [], [], []
        # Phrases with a term that the segment lacks go first, all at once.
        held = np.sort(np.fromiter(lists, np.int64, len(lists)))
        at = np.minimum(np.searchsorted(held, every), max(0, len(held) - 1))
        whole = np.logical_and.reduceat(held[at] == every, heads) if len(held) and len(every) else np.zeros(0, bool)
        for number in np.flatnonzero(whole).tolist():
            terms = wanted[number][1]
            got = [lists[t] for t in terms]
            order = sorted(range(len(got)), key=lambda i: len(got[i]))
            starts = got[order[0]] - order[0]
            for i in order[1:]:
                starts = starts[near(got[i], starts + i)]
                if not len(starts):
                    break
            if len(starts):
                item_of.append(np.full(len(starts), number))
                low.append(starts)
                high.append(starts + len(terms))
        if not item_of:
            return pd.DataFrame({"doc_row": np.zeros(0, np.int64), "item_id": np.zeros(0, object), "low": np.zeros(0, np.int64), "high": np.zeros(0, np.int64)})
        names = {name: k for k, name in enumerate(dict.fromkeys(n for n, _ in wanted))}
        name_of = np.array([names[n] for n, _ in wanted])
        item, low, high = name_of[np.concatenate(item_of)], np.concatenate(low), np.concatenate(high)
        doc = np.searchsorted(first, low, "right") - 1
        order = np.lexsort((low, item, doc))
        item, low, high, doc = item[order], low[order], high[order], doc[order]
        # Windows of an item may differ in length (its id may repeat): a run reaches to the largest end so far.
        other = np.concatenate([[False], (item[1:] != item[:-1]) | (doc[1:] != doc[:-1])])
        lift = np.cumsum(other) * (int(high.max()) + 1)
        reach = np.maximum.accumulate(high + lift) - lift
        opens = np.flatnonzero(np.concatenate([[True], other[1:] | (low[1:] > reach[:-1])]))
        last = np.concatenate([opens[1:], [len(low)]]) - 1
        base = first[doc[opens]]
        listed = np.array(list(names), object)
        return pd.DataFrame({"doc_row": docs["doc_row"].to_numpy(np.int64)[doc[opens]], "item_id": listed[item[opens]],
                             "low": low[opens] - base, "high": reach[last] - base})

    return match


def find_phrases(index: DataFrame, wanted: DataFrame, slop: int = 0, block: int = PHRASES) -> DataFrame:
    """Where the windows of ``wanted`` (item_id, terms) occur: doc_row, item_id, low, high.

    ``low`` and ``high`` bound a run of document words (from 0, end exclusive)
    that windows of the item cover without a break. With ``slop`` above 0 (at most
    32) each term may stand that many words off its place. The windows are
    taken in blocks of at most ``block``, each one pass over the postings of
    its terms.
    """
    if not 0 <= slop <= _GAP // 2:
        raise ValueError("slop is out of range")
    stored = materialise(wanted.withColumn("n", F.monotonically_increasing_id()), "phrases")
    cuts = stored.stat.approxQuantile("n", [i / max(1, -(-stored.count() // block)) for i in range(1, -(-stored.count() // block))], 0.001) if stored.count() > block else []
    found = None
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        rows = stored
        if low is not None:
            rows = rows.where(F.col("n") > low)
        if high is not None:
            rows = rows.where(F.col("n") <= high)
        listed = [(r["item_id"], np.array(r["terms"], np.int64)) for r in rows.collect()]
        terms = wanted.sparkSession.createDataFrame([(t,) for t in sorted({int(x) for _, ts in listed for x in ts})], "term long")
        # At most ``block`` windows of words, so the terms have a proven bound.
        postings = index.where("term is not null").join(F.broadcast(terms), "term", "left_semi")
        both = index.where("term is null").unionByName(postings).select(
            # No nulls beside numbers: pandas would turn 64-bit hashes into doubles.
            "segment", "postings", *(F.coalesce(c, F.lit(-1)).alias(c) for c in ("term", "doc_row", "first")))
        part = both.groupBy("segment").applyInPandas(_match(listed, slop), "doc_row long, item_id string, low long, high long")
        found = part if found is None else found.unionByName(part)
    return found


def documents_of(index: DataFrame) -> DataFrame:
    """doc_row, doc_id and n_words of every document of the index."""
    return index.where("term is null").select("doc_row", "doc_id", "n_words")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``n_hit`` counts the words inside any occurrence of a window, ``items_sha256``
    digests the items found, sorted as strings and joined by commas (a null
    item id is the empty string).
    """
    index = build_index(docs)
    spans = materialise(find_phrases(index, phrases(items, window)), "phrase-spans")
    # Union of the runs of a document: keep what each run adds beyond all that start before it.
    before = Window.partitionBy("doc_row").orderBy("low", "high", "item_id").rowsBetween(Window.unboundedPreceding, -1)
    added = spans.withColumn("reach", F.coalesce(F.max("high").over(before), F.lit(0))).select(
        "doc_row", "item_id", F.greatest(F.lit(0), F.col("high") - F.greatest("low", "reach")).alias("hit"))
    hits = added.groupBy("doc_row").agg(
        F.sum("hit").alias("n_hit"), F.array_sort(F.collect_set(F.coalesce("item_id", F.lit("")))).alias("items"))
    return documents_of(index).join(hits, "doc_row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
