"""Importance resampling of documents towards a target set, over hashed word n-grams.

Every run of one to ``longest`` words is a feature, its bucket the crc32 of its bytes. Text
is skewed: a short head of words makes up most of it. The head goes to every task once, as
the CRC state of each frequent word and of each frequent pair, found by the words' exact
bytes; a run that starts in the head continues from its state. All other features, the
tail, take their CRC directly. Both feed the same bucket totals, so the head saves work
and never changes a count. The log ratio of the two tables' totals is a bucket's gain; the
sum of gains plus Gumbel noise from a hash of the id orders the documents, and the
highest are drawn.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.text import LETTERS, Words, slices
from cohortkit.llm.vocabulary import encode, places
from cohortkit.session import materialise

#: Most words and pairs of the head, and the longest word in it: at most 5 MB go to a task.
HEAD_WORDS, HEAD_PAIRS, HEAD_BYTES = 32_768, 65_536, 64
# Count in a slice of text from which a word or pair is reported for the head.
_OFTEN = 16


@dataclass(frozen=True)
class Head:
    """Frequent words with the CRC state after each, and frequent pairs (first * words + second) with theirs."""

    words: pa.Array
    states: np.ndarray
    pairs: np.ndarray
    pair_states: np.ndarray


def _report(longest: int):
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words = Words(batch.column("text"), LETTERS)
                distinct, code = encode(words)
                count = np.bincount(code, minlength=len(distinct))
                short = np.fromiter(map(len, distinct.to_pylist()), np.int64, len(distinct)) <= HEAD_BYTES
                often = np.flatnonzero((count >= _OFTEN) & short)
                first, second, n = often, np.full(len(often), -1), count[often]
                if longest > 1 and len(code) > 1:
                    key = code[:-1] * len(distinct) + code[1:]
                    key, count = np.unique(key[words.row[:-1] == words.row[1:]], return_counts=True)
                    a, b = key // len(distinct), key % len(distinct)
                    often = (count >= _OFTEN) & short[a] & short[b]
                    first, second, n = (np.concatenate(x) for x in ((first, a[often]), (second, b[often]), (n, count[often])))
                spelled = distinct.cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [spelled.take(pa.array(first)), spelled.take(pa.array(second, mask=second < 0)), pa.array(n.astype(np.int64))],
                    names=["word", "second", "n"])

    return report


def head(docs: DataFrame, longest: int = 1, words: int = HEAD_WORDS, pairs: int = HEAD_PAIRS) -> Head:
    """The frequent words and pairs of ``docs`` (text), counted over all texts where they are frequent in a slice of them."""
    found = materialise(
        docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_report(longest), "word binary, second binary, n long")
        .groupBy("word", "second").agg(F.sum("n").alias("n")), "head")
    listed = [bytes(r["word"]) for r in found.where("second is null").orderBy(F.desc("n"), "word").limit(words).collect()]
    place = {w: i for i, w in enumerate(listed)}
    both = [(bytes(r["word"]), bytes(r["second"])) for r in found.where("second is not null").orderBy(F.desc("n"), "word", "second").limit(pairs).collect()] if longest > 1 else []
    both = sorted((place[a] * len(listed) + place[b], a + b" " + b) for a, b in both if a in place and b in place)
    return Head(
        pa.array(listed, pa.large_binary()), np.array([zlib.crc32(w) for w in listed], np.int64),
        np.array([k for k, _ in both], np.int64), np.array([zlib.crc32(x) for _, x in both], np.int64))


def _features(texts: pa.Array, known: Head, longest: int) -> tuple[Words, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """The words of a batch, and for each run length the row and the crc32 of every run."""
    words = Words(texts, LETTERS)

    def runs_of_words():
        distinct, code = encode(words)
        at = places(distinct, known.words)
        state = np.zeros(len(distinct), np.int64)
        state[at >= 0] = known.states[at[at >= 0]]
        spelled = distinct.to_pylist()
        for i in np.flatnonzero(at < 0).tolist():
            state[i] = zlib.crc32(spelled[i])
        yield words.row, state[code]
        start, run = np.arange(len(code)), code
        for n in range(2, longest + 1):
            fits = start + n - 1 < len(code)
            start, run = start[fits], run[fits]
            same = words.row[start] == words.row[start + n - 1]
            start, run = start[same], run[same]
            key, run = np.unique(run * len(spelled) + code[start + n - 1], return_inverse=True)
            first, last = key // max(1, len(spelled)), key % max(1, len(spelled))
            longer = np.full(len(key), -1, np.int64)
            if n == 2 and len(known.pairs):
                pair = at[first] * len(known.words) + at[last]
                spot = np.minimum(np.searchsorted(known.pairs, pair), len(known.pairs) - 1)
                hit = (at[first] >= 0) & (at[last] >= 0) & (known.pairs[spot] == pair)
                longer[hit] = known.pair_states[spot[hit]]
            for i in np.flatnonzero(longer < 0).tolist():
                longer[i] = zlib.crc32(b" " + spelled[last[i]], int(state[first[i]]))
            state = longer
            yield words.row[start], state[run]

    return words, runs_of_words()


def bucket_totals(docs: DataFrame, known: Head, longest: int = 1, buckets: int = 10_000) -> np.ndarray:
    """How many features of all of ``docs`` (text) fall into each bucket; a null text has none."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for whole in batches:
            for batch in slices(whole, "text"):
                for _, crc in _features(batch.column("text"), shared.value, longest)[1]:
                    total += np.bincount(crc % buckets, minlength=buckets)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled.astype(np.int32)), pa.array(total[filled])], names=["bucket", "n"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    totals = np.zeros(buckets, np.int64)
    for r in found.collect():  # one row a bucket
        totals[r["bucket"]] = r["n"]
    return totals


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of each bucket's share in the target to that in the source, add-one smoothed, rounded down."""
    s_all, t_all, size = int(source.sum()), int(target.sum()), len(source)
    return np.array([
        math.floor(1000 * math.log((float(t) + 1) * (s_all + size) / ((float(s) + 1) * (t_all + size))))
        for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weighted(docs: DataFrame, known: Head, gain: np.ndarray, longest: int = 1) -> DataFrame:
    """doc_id, n_words, n_features and weight (sum of the gains of the features) of each of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast((known, gain))

    def weigh(batches):
        known, gain = shared.value
        for whole in batches:
            for batch in slices(whole, "text"):
                words, found = _features(batch.column("text"), known, longest)
                n, weight = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
                for row, crc in found:
                    n += np.bincount(row, minlength=batch.num_rows)
                    # Sums of whole numbers far below 2**53, so doubles hold them exactly.
                    weight += np.bincount(row, gain[crc % len(gain)].astype(float), batch.num_rows).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(words.counts.astype(np.int64)), pa.array(n), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        weigh, "doc_id long, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame, target: DataFrame, share: tuple[int, int] = (10, 100), longest: int = 1, buckets: int = 10_000,
    seed: int = 2024, least_words: int = 20,
) -> DataFrame:
    """Draw the part ``share`` of ``docs`` (doc_id, text) that looks most like ``target`` (text).

    One row per row of ``docs``: doc_id, n_words, n_features, weight, score, rank (1, 2, 3... of the
    drawn, else null), all long. Words are letters, digits and everything beyond ASCII, A-Z in lower
    case. Only documents of at least ``least_words`` words can be drawn; the number drawn is their
    number times the share, rounded down. Ties go to the smaller doc_id. A null or empty text has no
    feature and weight 0; a null id is hashed as the empty text and comes last among equal
    scores; rows that share an id are documents of their own with the same noise; other columns
    are left out. An empty target makes rare buckets of the source weigh most; an empty source gives no rows.
    """
    known = head(docs, longest)
    source = bucket_totals(docs, known, longest, buckets)
    gain = gains(source, bucket_totals(target, known, longest, buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = materialise(
        weighted(docs, known, gain, longest).withColumn("score", F.col("weight") + noise), "weights")
    return _ranked(scored, share, least_words)


def _ranked(scored: DataFrame, share: tuple[int, int], least_words: int) -> DataFrame:
    """Ranks by a range sort: a row's place in its partition, plus the rows of the partitions before."""
    able = F.col("n_words") >= least_words
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("n_features"), F.desc("n_words")]
    placed = materialise(scored.where(able).orderBy(*order).withColumn("at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("at", 33)
    # One row for each partition of the sort.
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    drawn = share[0] * sum(n for _, n in sizes) // share[1]
    before, offsets = 0, []
    for number, n in sizes:
        offsets.append((number, before))
        before += n
    spark = scored.sparkSession
    starts = F.broadcast(spark.createDataFrame(offsets, "part long, before long"))
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = placed.withColumn("part", part).join(starts, "part").select(
        *scored.columns, F.when(rank <= drawn, rank).alias("rank"))
    return ranked.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))
