"""N-gram language model in Elias-Fano tries.

The documents are cut into blocks. Each block sends its distinct words and word
pairs, with their counts in training documents, to shards of the model as
Elias-Fano coded lists (a few bytes each). A shard adds the counts up and builds
its trie: sorted contexts, monotone pointers to their followers, the
followers made one increasing sequence by their context's number, and quantised
discounted counts as leaves. The levels are mapped from a file, and every block's
n-grams are looked up by a successor search within their context. The answers go
back to the block, whose documents meet them and are scored. A frequent context or
follower is spread over all shards, because the shard depends on both words.

P(w | v) = (c'(v, w) + MASS * P(w)) / (c(v) + MASS), P(w) = (c + 1/2) / (N + (V + 1) / 2),
with c' the quantised count, never above the true one. Words keep exact counts.
"""

from __future__ import annotations

import os
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.text import NOT_BLANK, Words, slices
from cohortkit.session import materialise

#: Bits of a word's hash inside a pair, share of the smoothing mass, text in a block.
HALF, MASS, BLOCK = 28, 1000.0, 6 << 20
_START, _END = np.uint64(0x5DEECE66D1234567), np.uint64(0x2545F4914F6CDD1D)
_U = np.uint64


class EliasFano:
    """A non-decreasing sequence of integers below ``2**bits``: low bits packed, high bits in unary."""

    @staticmethod
    def pack(values: np.ndarray, bits: int) -> bytes:
        n = len(values)
        low = max(0, bits - max(1, n).bit_length())
        values = values.astype(np.uint64)
        out = np.array([n, low], "<u4").tobytes()
        if not n:
            return out
        high = (values >> _U(low)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(high[-1]) + 1, np.uint8)
        unary[high] = 1
        if low:
            wide = np.unpackbits((values & _U((1 << low) - 1)).astype(">u8").view(np.uint8).reshape(n, 8), axis=1)[:, 64 - low :]
            out += np.packbits(wide).tobytes()
        return out + np.packbits(unary).tobytes()

    @staticmethod
    def unpack(blob: bytes) -> np.ndarray:
        n, low = (int(x) for x in np.frombuffer(blob, "<u4", 2))
        if not n:
            return np.zeros(0, np.uint64)
        size = (n * low + 7) // 8
        unary = np.unpackbits(np.frombuffer(blob, np.uint8, offset=8 + size))
        high = np.flatnonzero(unary)[:n] - np.arange(n)
        if not low:
            return high.astype(np.uint64)
        wide = np.zeros((n, 64), np.uint8)
        wide[:, 64 - low :] = np.unpackbits(np.frombuffer(blob, np.uint8, size, 8), count=n * low).reshape(n, low)
        return (high.astype(np.uint64) << _U(low)) | np.packbits(wide, axis=1).view(">u8").ravel().astype(np.uint64)


def quantise(counts: np.ndarray) -> np.ndarray:
    """Counts as one byte: exact up to 8, then eight steps an octave, rounded down."""
    c = counts.astype(float)
    steps = np.floor(8 * np.log2(np.maximum(c, 8) / 8) + 1e-9)
    return np.where(c <= 8, c, np.minimum(255, 8 + steps)).astype(np.uint8)


def restored(leaves: np.ndarray) -> np.ndarray:
    q = leaves.astype(float)
    return np.where(q <= 8, q, 8 * 2 ** ((q - 8) / 8))


class Trie:
    """Contexts, pointers, followers and leaves of a shard, as mapped levels."""

    def __init__(self, levels: dict[str, np.ndarray]):
        self.levels = levels

    @staticmethod
    def build(pairs: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
        """From sorted distinct pairs (context above the low ``bits``) and their counts."""
        context, follower = pairs >> _U(bits), pairs & _U((1 << bits) - 1)
        heads = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(pairs) else np.zeros(0, np.int64)
        number = np.repeat(np.arange(len(heads)), np.diff(np.concatenate([heads, [len(pairs)]])))
        relative = (number.astype(np.uint64) << _U(bits)) | follower
        wide = bits + max(1, len(heads)).bit_length()
        parts = [EliasFano.pack(context[heads], HALF + 1), EliasFano.pack(heads, max(1, len(pairs)).bit_length() + 1),
                 EliasFano.pack(relative, wide), quantise(counts).tobytes()]
        return np.array([bits, *map(len, parts)], "<u8").tobytes() + b"".join(parts)

    @classmethod
    def mapped(cls, path: str) -> Trie:
        """Levels of a trie file, mapped rather than read."""
        data = np.memmap(path, np.uint8, "r")
        bits, *sizes = (int(x) for x in data[:40].view("<u8"))
        cuts = 40 + np.cumsum([0, *sizes])
        part = [data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        contexts, pointers, relative = (EliasFano.unpack(p) for p in part[:3])
        return cls({"bits": bits, "contexts": contexts, "pointers": np.append(pointers, _U(len(relative))), "relative": relative, "leaves": part[3]})

    def lookup(self, pairs: np.ndarray) -> np.ndarray:
        """Leaves of the pairs, 0 for those that are not there."""
        at = self.levels
        bits, contexts, relative = at["bits"], at["contexts"], at["relative"]
        if not len(relative):
            return np.zeros(len(pairs), np.uint8)
        context = pairs >> _U(bits)
        node = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
        wanted = (node.astype(np.uint64) << _U(bits)) | (pairs & _U((1 << bits) - 1))
        # The node's number leads each follower, so this search never leaves its pointer range.
        place = np.searchsorted(relative, wanted)
        found = (contexts[node] == context) & (place < at["pointers"][node + 1].astype(np.int64))
        place = np.minimum(place, len(relative) - 1)
        return np.where(found & (relative[place] == wanted), at["leaves"][place], 0).astype(np.uint8)


class _Block:
    """Tokens of a block of documents and its sorted distinct n-grams."""

    def __init__(self, texts: pa.Array, shard_bits: int):
        words = Words(texts, NOT_BLANK)
        n = words.counts
        self.ends = np.cumsum(n + 1)
        self.row = np.repeat(np.arange(len(n)), n + 1)
        tokens = np.empty(int(self.ends[-1]) if len(n) else 0, np.uint64)
        final = np.zeros(len(tokens), bool)
        final[self.ends - 1] = True
        tokens[final] = _END
        tokens[~final] = words.hashes()
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[self.ends - n - 1] = _START
        self.final, self.lengths = final, n + 1
        a, b = before >> _U(64 - HALF), tokens >> _U(64 - HALF)
        keep = HALF - shard_bits
        # The shard is implied by the context and the follower's top bits: they are not stored again.
        shard = (a >> _U(keep)) ^ (b >> _U(keep)) if shard_bits else np.zeros_like(a)
        pair = (shard << _U(2 * HALF - shard_bits)) | (a << _U(keep)) | (b & _U((1 << keep) - 1))
        self.words, self.word_of = np.unique(tokens, return_inverse=True)
        self.pairs, self.pair_of = np.unique(pair, return_inverse=True)
        self.before = before
        self.shard_bits = shard_bits

    def sections(self, kind: int) -> Iterator[tuple[int, int, int]]:
        """(shard, from, to) of the sorted n-grams of a kind (1 words, 2 pairs)."""
        keys, shift = (self.words, 64 - self.shard_bits) if kind == 1 else (self.pairs, 2 * HALF - self.shard_bits)
        shards = 1 << self.shard_bits
        cuts = np.searchsorted(keys, np.arange(shards, dtype=np.uint64) << _U(shift)) if self.shard_bits else np.array([0])
        return zip(range(shards), cuts.tolist(), [*cuts[1:].tolist(), len(keys)], strict=True)


def _blocks(batches):
    part, number = TaskContext.get().partitionId(), 0
    for whole in batches:
        for batch in slices(whole, "text", BLOCK):
            yield f"{part}-{number}", batch
            number += 1


def _send(shard_bits: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, batch in _blocks(batches):
            block = _Block(batch.column("text"), shard_bits)
            learn = batch.column("learn").fill_null(False).to_numpy(zero_copy_only=False)[block.row]
            rows = []
            for kind, keys, of in ((1, block.words, block.word_of), (2, block.pairs, block.pair_of)):
                bits = (64 if kind == 1 else 2 * HALF) - shard_bits
                counts = np.bincount(of[learn], minlength=len(keys)).astype("<u4")
                for shard, a, b in block.sections(kind):
                    if b > a:
                        rows.append((kind, shard, name, EliasFano.pack(keys[a:b] & _U((1 << bits) - 1), bits), zlib.compress(counts[a:b], 1)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary()), strict=True)],
                names=["kind", "shard", "block", "keys", "counts"])

    return send


def _answer(shard_bits: int):
    def answer(key, frame):
        kind, shard = int(key[0]), int(key[1])
        lists = [EliasFano.unpack(k) for k in frame["keys"]]
        counts = [np.frombuffer(zlib.decompress(c), "<u4") for c in frame["counts"]]
        seen = [(k[c > 0], c[c > 0]) for k, c in zip(lists, counts, strict=True)]
        keys = np.concatenate([k for k, _ in seen])
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], np.concatenate([c for _, c in seen])[order].astype(np.int64)
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        keys, n = keys[heads], np.add.reduceat(n, heads) if len(heads) else n
        if kind == 1:
            model = EliasFano.pack(keys, 64 - shard_bits) + zlib.compress(n.astype("<u8"), 1)
            replies = []
            for wanted in lists:
                at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
                got = np.where(keys[at] == wanted, n[at], 0) if len(keys) else np.zeros(len(wanted))
                replies.append(zlib.compress(got.astype("<u8"), 1))
        else:
            model = Trie.build(keys, n, HALF - shard_bits)
            with tempfile.TemporaryDirectory() as folder:
                path = os.path.join(folder, "trie")
                with open(path, "wb") as file:
                    file.write(model)
                trie = Trie.mapped(path)
                replies = [zlib.compress(trie.lookup(wanted), 1) for wanted in lists]
                del trie
        return pd.DataFrame({
            "kind": kind, "shard": shard, "block": [*frame["block"], None], "reply": [*replies, model],
            "tokens": [*[0] * len(replies), int(n.sum())], "types": [*[0] * len(replies), len(keys)]})

    return answer


def train_and_score(docs: DataFrame, learn: Column, shard_bits: int | None = None, mass: float = MASS) -> tuple[DataFrame, DataFrame]:
    """Learn from the rows of ``docs`` (doc_id, text) where ``learn`` holds, and score all rows.

    Returns the model (kind, shard, blob: exact word counts, and a trie of pairs,
    per shard) and one row per document: doc_id, learn, n_tokens, n_known,
    train_tokens, base_score, score (log10). Tokens are the words between blanks, A-Z
    in lower case, and one end; a null text is the end alone. Null and repeated ids
    stay separate rows. Nothing to learn from gives every token the same
    probability. The number of shards follows the number of input partitions.
    """
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), learn.alias("learn"))
    if shard_bits is None:
        parts = chosen._jdf.queryExecution().toRdd().getNumPartitions()
        shard_bits = min(16, max(3, (2 * parts - 1).bit_length() - 1))
    sent = chosen.mapInArrow(_send(shard_bits), "kind int, shard int, block string, keys binary, counts binary")
    replies = materialise(
        sent.groupBy("kind", "shard").applyInPandas(
            _answer(shard_bits), "kind int, shard int, block string, reply binary, tokens long, types long"), "ngram-replies")
    model = replies.where("block is null").select("kind", "shard", F.col("reply").alias("blob"))
    totals = replies.where("block is null and kind = 1").agg(F.sum("tokens").alias("n"), F.sum("types").alias("v")).first()
    tokens, types = int(totals["n"] or 0), int(totals["v"] or 0)

    def keyed(batches):
        for name, batch in _blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array([name] * batch.num_rows, pa.string()), *batch.columns], names=["block", *batch.schema.names])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        # Rows of a block arrive in the order of their pieces; the order of rows does not change the n-grams.
        block = _Block(left.column("text").combine_chunks() if left.num_rows else pa.array([], pa.string()), shard_bits)
        got = {(k, s): r for k, s, r in zip(right.column("kind").to_pylist(), right.column("shard").to_pylist(), right.column("reply").to_pylist(), strict=True)}
        answers = []
        for kind, kind_type in ((1, "<u8"), (2, np.uint8)):
            parts = []
            for shard, a, b in block.sections(kind):
                part = np.frombuffer(zlib.decompress(got[kind, shard]), kind_type) if b > a else np.zeros(0, kind_type)
                if len(part) != b - a:
                    raise ValueError("the documents changed between the two readings")
                parts.append(part)
            answers.append(np.concatenate(parts))
        count = answers[0].astype(float)[block.word_of]
        start = float(answers[0][np.searchsorted(block.words, _END)]) if len(block.words) else 0.0
        base = (count + 0.5) / (tokens + 0.5 * (types + 1))
        context = np.empty_like(count)
        context[1:] = count[:-1]
        context[block.ends - block.lengths] = start
        full = (restored(answers[1])[block.pair_of] + mass * base) / (context + mass)
        rows = len(block.ends)
        size = lambda values: np.bincount(block.row, values, rows)
        return pa.table({
            "doc_id": left.column("doc_id"), "learn": left.column("learn"), "n_tokens": pa.array(block.lengths.astype(np.int64)),
            "n_known": pa.array(size((count > 0).astype(float)).astype(np.int64)),
            "base_score": pa.array(size(np.log10(base))), "score": pa.array(size(np.log10(full)))})

    again = chosen.mapInArrow(keyed, "block string, doc_id long, text string, learn boolean")
    scored = again.groupBy("block").cogroup(replies.where("block is not null").select("kind", "shard", "block", "reply").groupBy("block")).applyInArrow(
        score, "doc_id long, learn boolean, n_tokens long, n_known long, base_score double, score double")
    return model, scored.select("doc_id", "learn", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
