"""Removal of repeated byte strings by distributed suffix sorting.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else.
Equal strings have equal anchors: of the ``_GRAM``-byte grams inside a string, the
one with the least hash stands at the same place in each of its copies. So

1. blocks of documents send the anchors' hashes (Elias-Fano coded) with a
   fingerprint of each anchor's context, the bytes of all strings that have it
   as anchor; shards answer which contexts repeat as a whole, and which must
   be compared in detail, because the gram repeats in other contexts;
2. the contexts to be compared, one copy each, go to the shard of their gram and
   are sorted there by induced sorting (``induced``); a shard is dealt by gram into
   files until each piece fits ``PIECE`` bytes, so memory does not follow the shard;
   the strings of a gram with more than ``MANY`` contexts go by their own
   fingerprints to all shards instead, each once per block;
3. each block takes the answers and cuts its documents.

A context with thousands of copies travels at most once, and what is unique
travels as a hash of a few bytes.
"""

from __future__ import annotations

import os
import tempfile
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from cohortkit.llm.induced import repeated_windows
from cohortkit.llm.scoring import EliasFano
from cohortkit.llm.text import _STEP, _TABLE, buffers, mix, powers, slices
from cohortkit.session import materialise

LENGTH, _GRAM, BLOCK = 200, 48, 1 << 20
#: Bytes of contexts that are sorted at a time, and differing contexts from which a gram's strings are judged one by one.
PIECE, MANY = 8 << 20, 4096
#: Anchors that are sorted at a time, and bytes of the input's files for each shard of anchors.
JUDGED, SHARD = 1 << 18, 64 << 20
_REPEATED, _COMPARE, _MANY = 1, 2, 4
# Levels of 64 files into which a shard may be dealt.
_LEVELS = 4
_INVERSE = np.uint64(pow(int(_STEP), -1, 1 << 64))


@lru_cache(maxsize=1)
def _inverse(n: int) -> np.ndarray:
    out = np.full(n, _INVERSE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Anchors:
    """Anchors of a block: hash, context (from the first string's start to the last one's end) and strings each."""

    def __init__(self, texts: pa.Array, length: int):
        self.data, self.offsets = buffers(texts)
        n = len(self.data)
        gram = min(_GRAM, length)
        self.hash = self.print = np.zeros(0, np.uint64)
        self.low = self.high = np.zeros(0, np.int64)
        self.length = length
        if n < length:
            return
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[self.data] * powers(n), out=total[1:])
        back = _inverse(1 << max(20, (n - 1).bit_length()))
        grams = mix((total[gram:] - total[:-gram]) * back[: n - gram + 1])
        place = np.arange(len(grams), dtype=np.uint64)
        least = (grams >> np.uint64(28) << np.uint64(28)) | place
        wide, span = length - gram + 1, 1
        while 2 * span <= wide:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if wide > span:
            least = np.minimum(least[: len(least) - (wide - span)], least[wide - span :])
        starts = np.zeros(n + 1, np.int32)
        first, last = self.offsets[:-1], self.offsets[1:] - length + 1
        long = last > first
        np.add.at(starts, first[long], 1)
        np.add.at(starts, last[long], -1)
        valid = np.flatnonzero(np.cumsum(starts)[: len(least)] > 0)
        if not len(valid):
            return
        anchor = (least[valid] & np.uint64((1 << 28) - 1)).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1)]))
        low, anchor = valid[new], anchor[new]
        high = valid[np.concatenate([new[1:], [len(valid)]]) - 1]
        ends = high + length
        prints = mix((total[ends] - total[low]) * back[low] + mix(((ends - low) << 20 | (anchor - low)).astype(np.uint64)))
        # An anchor has the least hash of many, so its hash is small; mixed once more, the anchors spread evenly over the shards.
        hashes = mix(grams[anchor])
        order = np.lexsort((low, prints, hashes))
        self.hash, self.print, self.low, self.high = hashes[order], prints[order], low[order], high[order]

    def strings(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Strings of the grams with many contexts: distinct fingerprints and their counts; starts, and the fingerprint of each."""
        chosen = np.flatnonzero(states & _MANY)
        if not len(chosen):
            return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
        low, n = self.low[chosen], self.high[chosen] - self.low[chosen] + 1
        start = np.arange(int(n.sum())) + np.repeat(low - np.cumsum(n) + n, n)
        # Summed again here, as few blocks have such grams and the sums are as long as the block.
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_TABLE[self.data] * powers(len(self.data)), out=total[1:])
        back = _inverse(1 << max(20, (len(self.data) - 1).bit_length()))
        prints, which, copies = np.unique(mix((total[start + self.length] - total[start]) * back[start]), return_inverse=True, return_counts=True)
        return prints, copies, start, which


def _blocks(batches: Iterator[pa.RecordBatch]):
    part, number = TaskContext.get().partitionId(), 0
    for whole in batches:
        for batch in slices(whole, "text", BLOCK):
            yield f"{part}-{number}", batch
            number += 1


def _cuts(keys: np.ndarray, shard_bits: int) -> list[tuple[int, int, int]]:
    shards = 1 << shard_bits
    bounds = np.searchsorted(keys, np.arange(shards, dtype=np.uint64) << np.uint64(64 - shard_bits)).tolist()
    return list(zip(range(shards), bounds, [*bounds[1:], len(keys)], strict=True))


def _send(length: int, shard_bits: int):
    mask = np.uint64((1 << (64 - shard_bits)) - 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, batch in _blocks(batches):
            anchors = _Anchors(batch.column("text"), length)
            rows = [(s, name, EliasFano.pack(anchors.hash[a:b] & mask, 64 - shard_bits), anchors.print[a:b].tobytes())
                    for s, a, b in _cuts(anchors.hash, shard_bits) if b > a]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.string(), pa.binary(), pa.binary()), strict=True)],
                    names=["shard", "block", "keys", "prints"])

    return send


def _judge(frame, many: int):
    """Per anchor of each block: whether its context repeats, and whether it is to be compared, string by string if ``many`` differ."""
    keys = [EliasFano.unpack(k) for k in frame["keys"]]
    prints = [np.frombuffer(p, np.uint64) for p in frame["prints"]]
    out = [np.empty(len(k), np.uint8) for k in keys]
    # Sorting takes several times its rows, so it goes by ranges of keys; a block's keys ascend.
    ranges = 1 + sum(len(k) for k in keys) // JUDGED
    bounds = np.linspace(0, float(max(k[-1] for k in keys)), ranges + 1)[1:-1].astype(np.uint64)
    cuts = [[0, *np.searchsorted(k, bounds).tolist(), len(k)] for k in keys]
    for i in range(ranges):
        mine = [(n, c[i], c[i + 1]) for n, c in enumerate(cuts) if c[i + 1] > c[i]]
        if mine:
            state = _judge_range(np.concatenate([keys[n][a:b] for n, a, b in mine]), np.concatenate([prints[n][a:b] for n, a, b in mine]), many)
            at = 0
            for n, a, b in mine:
                out[n][a:b] = state[at : at + b - a]
                at += b - a
    return pd.DataFrame({"shard": frame["shard"], "block": frame["block"], "reply": [zlib.compress(x.tobytes(), 1) for x in out]})


def _judge_range(key: np.ndarray, prints: np.ndarray, many: int) -> np.ndarray:
    order = np.lexsort((prints, key))
    k, p = key[order], prints[order]
    new_key = np.concatenate([[True], k[1:] != k[:-1]])
    new = new_key | np.concatenate([[True], p[1:] != p[:-1]])
    heads = np.flatnonzero(new)
    copies = np.diff(np.append(heads, len(key)))
    first = np.flatnonzero(new_key[heads])
    contexts = np.diff(np.append(first, len(heads)))
    kind = np.where(contexts > many, _MANY, np.where(contexts > 1, _COMPARE, 0)).astype(np.uint8)
    state = np.repeat(np.where(copies > 1, _REPEATED, 0).astype(np.uint8), copies)
    state[heads] |= np.repeat(kind, contexts)
    out = np.empty(len(key), np.uint8)
    out[order] = state
    return out


def _states(anchors: _Anchors, shard_bits: int, replies: pa.Table) -> np.ndarray:
    got = dict(zip(replies.column("shard").to_pylist(), replies.column("reply").to_pylist(), strict=True))
    parts = [np.frombuffer(zlib.decompress(got[s]), np.uint8) for s, a, b in _cuts(anchors.hash, shard_bits) if b > a]
    out = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    if len(out) != len(anchors.hash):
        raise ValueError("the documents changed between two readings")
    return out


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by("block_row") if table.num_rows else table


def _contexts(length: int, shard_bits: int):
    mask = np.uint64((1 << (64 - shard_bits)) - 1)

    def contexts(left: pa.Table, right: pa.Table) -> pa.Table:
        left = _ordered(left)
        anchors = _Anchors(left.column("text").combine_chunks(), length)
        judged = _states(anchors, shard_bits, right)
        name = right.column("block")[0].as_py() if right.num_rows else ""
        sent = np.flatnonzero(judged & _COMPARE)
        raw = anchors.data.tobytes()
        low, high = anchors.low[sent].tolist(), anchors.high[sent].tolist()
        # A row with ``twice`` holds fingerprints of strings of one shard, whose number stands as gram and place.
        prints, copies, _, _ = anchors.strings(judged)
        cuts = [(s, a, b) for s, a, b in _cuts(prints, shard_bits) if b > a]
        shards = np.array([s for s, _, _ in cuts], np.int64)
        return pa.table({
            "gram": pa.array(np.concatenate([anchors.hash[sent].view(np.int64), shards])), "block": pa.array([name] * (len(sent) + len(cuts)), pa.string()),
            "at": pa.array(np.concatenate([anchors.low[sent], shards])),
            "known": pa.array(np.concatenate([(judged[sent] & _REPEATED) > 0, np.zeros(len(cuts), bool)])),
            "bytes": pa.array([*(raw[a : b + length] for a, b in zip(low, high, strict=True)),
                               *(EliasFano.pack(prints[a:b] & mask, 64 - shard_bits) for _, a, b in cuts)], pa.binary()),
            "twice": pa.array([*[None] * len(sent), *(np.packbits(copies[a:b] > 1).tobytes() for _, a, b in cuts)], pa.binary())})

    return contexts


def _pieces(batches: Iterable[pa.RecordBatch], folder: str, most: int, level: int = 0) -> Iterator[list[pa.RecordBatch]]:
    """The rows in pieces of about ``most`` bytes, all rows of a gram in one piece; beyond that they are dealt into files."""
    held, size, batches = [], 0, iter(batches)
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size > most and level < _LEVELS:
            break
    else:
        if held:
            yield held
        return
    files = {}
    for batch in chain(held, batches):
        place = (mix(batch.column("gram").to_numpy().view(np.uint64)) >> np.uint64(58 - 6 * level)).astype(np.int64) & 63
        order = np.argsort(place, kind="stable")
        ordered, cuts = batch.take(pa.array(order)), np.searchsorted(place[order], np.arange(65)).tolist()
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a:
                if i not in files:
                    files[i] = pa.ipc.new_stream(os.path.join(folder, f"deal-{level}-{i}"), batch.schema)
                files[i].write_batch(ordered.slice(a, b - a))
    held.clear()
    for file in files.values():
        file.close()
    for i in files:
        path = os.path.join(folder, f"deal-{level}-{i}")
        with pa.OSFile(path) as file, pa.ipc.open_stream(file) as dealt:
            yield from _pieces(dealt, folder, most, level + 1)
        os.unlink(path)


def _answers(shard: np.ndarray, block: pa.Array, reply: list | None, low: np.ndarray | None, high: np.ndarray | None) -> pa.RecordBatch:
    n = len(shard)
    return pa.RecordBatch.from_arrays(
        [pa.array(shard.astype(np.int32)), block, pa.nulls(n, pa.binary()) if reply is None else pa.array(reply, pa.binary()),
         *(pa.nulls(n, pa.int64()) if x is None else pa.array(x) for x in (low, high))],
        names=["shard", "block", "reply", "low", "high"])


def _judge_strings(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Per fingerprint of each block: whether it stands anywhere else. The answer to shard s is row -2 - s."""
    shard = rows.column("at").to_numpy()
    out: list = [None] * len(shard)
    for s in np.unique(shard):
        mine = np.flatnonzero(shard == s)
        keys = [EliasFano.unpack(rows.column("bytes")[i].as_py()) for i in mine.tolist()]
        sizes = [len(k) for k in keys]
        twice = [np.unpackbits(np.frombuffer(rows.column("twice")[i].as_py(), np.uint8), count=n) for i, n in zip(mine.tolist(), sizes, strict=True)]
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        repeated = np.bincount(which, 1 + np.concatenate(twice))[which] > 1
        for i, part in zip(mine.tolist(), np.split(repeated, np.cumsum(sizes)[:-1]), strict=True):
            out[i] = np.packbits(part).tobytes()
    return _answers(-2 - shard, rows.column("block"), out, None, None)


def _string_states(prints: np.ndarray, shard_bits: int, replies: pa.Table) -> np.ndarray:
    got = dict(zip(replies.column("shard").to_pylist(), replies.column("reply").to_pylist(), strict=True))
    parts = [np.unpackbits(np.frombuffer(got[-2 - s], np.uint8), count=b - a) for s, a, b in _cuts(prints, shard_bits) if b > a]
    return np.concatenate(parts) > 0 if parts else np.zeros(0, bool)


def _sort(length: int, most: int):
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:
            for piece in _pieces(batches, folder, most):
                strings, contexts = [], []
                for batch in piece:
                    of_strings = pc.is_valid(batch.column("twice"))
                    strings.append(batch.filter(of_strings))
                    contexts.append(batch.filter(pc.invert(of_strings)))
                if any(batch.num_rows for batch in strings):
                    yield _judge_strings(pa.Table.from_batches(strings).combine_chunks().to_batches()[0])
                yield from _sorted_piece(contexts, length, folder)

    return sort


def _sorted_piece(batches: list[pa.RecordBatch], length: int, parent: str) -> Iterator[pa.RecordBatch]:
    with tempfile.TemporaryDirectory(dir=parent) as folder:
        path, size = os.path.join(folder, "text"), 0
        blocks, at, begin, number, known = [], [], [], [], []
        with open(path, "wb") as file:
            for batch in batches:
                for context in batch.column("bytes").to_pylist():
                    raw = np.frombuffer(context, np.uint8) + np.uint8(1)
                    file.write(raw.tobytes() + b"\0")
                    begin.append(size)
                    number.append(len(context) - length + 1)
                    size += len(context) + 1
                blocks.append(batch.column("block"))
                at.append(batch.column("at").to_numpy())
                known.append(batch.column("known").to_numpy(zero_copy_only=False))
            file.write(bytes(length + 8))
        if not size:
            return
        begin, number = np.array(begin), np.array(number)
        allowed = np.zeros(size + 1, np.int32)
        allowed[begin] += 1
        np.add.at(allowed, begin + number, -1)
        found = repeated_windows(path, size, np.cumsum(allowed)[:-1] > 0, length, folder)
    blocks, at, known = pa.concat_arrays(blocks), np.concatenate(at), np.concatenate(known)
    edges = np.diff(np.concatenate([[0], found.astype(np.int8), [0]]))
    low, high = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1
    # Strings of neighbouring contexts never touch: each context ends in bytes where no string may start.
    which = np.searchsorted(begin, low, "right") - 1
    fresh = ~known[which]
    low, high, which = low[fresh], high[fresh], which[fresh]
    for s in range(0, max(1, len(low)), 50_000):
        w = which[s : s + 50_000]
        yield _answers(np.full(len(w), -1), blocks.take(pa.array(w)), None, at[w] + low[s : s + 50_000] - begin[w], at[w] + high[s : s + 50_000] - begin[w])


def _cut(length: int, shard_bits: int, whole_characters: bool, columns: list[str], schema: pa.Schema):
    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        left = _ordered(left)
        texts = left.column("text").combine_chunks() if left.num_rows else pa.array([], pa.string())
        anchors = _Anchors(texts, length)
        data, offsets = anchors.data, anchors.offsets
        judged = right.filter(pc.greater_equal(right.column("shard"), 0))
        compared = right.filter(pc.equal(right.column("shard"), -1))
        states = _states(anchors, shard_bits, judged)
        whole = (states & _REPEATED) > 0
        prints, _, start, which = anchors.strings(states)
        start = start[_string_states(prints, shard_bits, right.filter(pc.less(right.column("shard"), -1)))[which]]
        edges = np.zeros(len(data) + 1, np.int32)
        np.add.at(edges, anchors.low[whole], 1)
        np.add.at(edges, anchors.high[whole] + length, -1)
        np.add.at(edges, compared.column("low").to_numpy().astype(np.int64), 1)
        np.add.at(edges, compared.column("high").to_numpy().astype(np.int64) + length, -1)
        np.add.at(edges, start, 1)
        np.add.at(edges, start + length, -1)
        gone = np.cumsum(edges)[:-1] > 0
        if whole_characters and len(data):
            letter = np.cumsum((data & 0xC0) != 0x80) - 1
            gone = (np.bincount(letter, ~gone) == 0)[letter]
        kept = np.concatenate([[0], np.cumsum(~gone)])[offsets].astype(np.int32)
        inside = np.concatenate([[False], gone, [False]])
        breaks = np.zeros(len(data) + 1, bool)
        breaks[offsets] = True
        starts = np.flatnonzero(gone & (~inside[:-2] | breaks[:-1]))
        ends = np.flatnonzero(gone & (~inside[2:] | breaks[1:])) + 1
        row = np.searchsorted(offsets, starts, "right") - 1
        spans = pa.StructArray.from_arrays([pa.array(starts - offsets[row]), pa.array(ends - starts)], names=["start", "length"])
        bounds = pa.array(np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32))
        body = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(kept), pa.py_buffer(data[~gone].tobytes())])
        out = pa.table({**{c: left.column(c) for c in columns}, "spans": pa.ListArray.from_arrays(bounds, spans), "kept": body})
        return out.cast(schema) if out.num_rows else schema.empty_table()

    return cut


def cut_repeats(docs: DataFrame, length: int = LENGTH, whole_characters: bool = False, shard_bits: int | None = None,
                piece: int = PIECE, many: int = MANY) -> DataFrame:
    """``docs`` (text and any other columns) with ``spans`` and ``kept``.

    ``spans`` holds the removed runs as (start, length) in bytes of the text, ``kept``
    the remaining bytes. A byte goes if a string of ``length`` bytes over it
    starts at any other place of any row, overlapping ones included; with ``whole_characters`` a character
    stays unless all its bytes go. A null text is empty; repeated rows count as places of their own; an empty
    table gives no rows. ``docs`` is read several times and must give the same
    rows in the same partitions each time; otherwise an error is raised.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    others = [c for c in docs.columns if c not in ("spans", "kept")]
    chosen = docs.select(*(F.col("text").cast("string").alias("text") if c == "text" else F.col(f"`{c}`") for c in others))
    if shard_bits is None:
        parts = chosen._jdf.queryExecution().toRdd().getNumPartitions()
        # As many shards as partitions where those are few; beyond, by the bytes that the partitions hold at most, since each block writes a row a shard.
        size = parts * docs.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
        shard_bits = min(16, max(3, min(6, (parts - 1).bit_length()), (size // SHARD).bit_length()))
    # Every reading has the same columns: a round-robin shuffle before it deals rows by their whole content.
    judged = materialise(
        chosen.mapInArrow(_send(length, shard_bits), "shard int, block string, keys binary, prints binary")
        .groupBy("shard").applyInPandas(lambda frame: _judge(frame, many), "shard int, block string, reply binary"), "anchor-replies")

    def keyed(batches):
        for name, batch in _blocks(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * batch.num_rows, pa.string()), pa.array(np.arange(batch.num_rows)), *batch.columns],
                names=["block", "block_row", *batch.schema.names])

    def blocks(frame: DataFrame) -> DataFrame:
        fields = [StructField("block", _string()), StructField("block_row", LongType()), *frame.schema.fields]
        return frame.mapInArrow(keyed, StructType(fields))

    contexts = blocks(chosen).select("block", "block_row", "text").groupBy("block").cogroup(judged.groupBy("block")).applyInArrow(
        _contexts(length, shard_bits), "gram long, block string, at long, known boolean, bytes binary, twice binary")
    replies = "shard int, block string, reply binary, low long, high long"
    compared = materialise(contexts.repartition("gram").mapInArrow(_sort(length, piece), replies), "compared")
    answers = judged.withColumns({"low": F.lit(None).cast("long"), "high": F.lit(None).cast("long")}).unionByName(compared)
    spans = StructField("spans", ArrayType(StructType([StructField("start", LongType()), StructField("length", LongType())])))
    schema = StructType([*chosen.schema.fields, spans, StructField("kept", BinaryType())])
    return blocks(chosen).groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _cut(length, shard_bits, whole_characters, others, to_arrow_schema(schema)), schema)


def _string():
    from pyspark.sql.types import StringType

    return StringType()
