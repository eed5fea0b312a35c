"""Words and hashes of whole Arrow batches of text, as NumPy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Byte classes: words between blanks, and words of digits, letters and all bytes beyond ASCII.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
LETTERS = np.zeros(256, dtype=bool)
LETTERS[0x30:0x3A] = LETTERS[0x61:0x7B] = LETTERS[0x41:0x5B] = LETTERS[0x80:] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the hash's odd multiplier, modulo 2**64."""
    out = np.full(n, _STEP, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string array; a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


class Words:
    """Words of a batch: byte spans, the row of each word, and the first word of each row."""

    def __init__(self, texts: pa.Array, inside: np.ndarray):
        data, self.offsets = buffers(texts)
        self.data = LOWER[data]
        kept = inside[self.data]
        before = np.empty_like(kept)
        after = np.empty_like(kept)
        if len(kept):
            before[0], before[1:] = False, kept[:-1]
            after[-1], after[:-1] = False, kept[1:]
            bounds = self.offsets[(self.offsets > 0) & (self.offsets < len(kept))]
            before[bounds] = False
            after[bounds - 1] = False
        self.kept = kept
        self.starts = np.flatnonzero(kept & ~before)
        self.ends = np.flatnonzero(kept & ~after) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        lengths = self.ends - self.starts
        if not len(lengths):
            return np.zeros(0, np.uint64)
        powered = powers(int(lengths.max()))
        letters = self.data[self.kept]
        ends = np.cumsum(lengths)
        out = np.empty(len(lengths), np.uint64)
        low = 0
        while low < len(lengths):  # a megabyte of letters at a time keeps the arrays small
            begin = int(ends[low] - lengths[low])
            high = max(low + 1, int(np.searchsorted(ends, begin + (1 << 20), "right")))
            at = ends[low:high] - lengths[low:high] - begin
            place = np.arange(int(ends[high - 1]) - begin, dtype=np.int32) - np.repeat(at.astype(np.int32), lengths[low:high])
            values = _TABLE[letters[begin : int(ends[high - 1])]] * powered[place]
            out[low:high] = np.add.reduceat(values, at)
            low = high
        return mix(out + lengths.astype(np.uint64))


def slices(batch: pa.RecordBatch, column: str, most: int = 6 << 20):
    """Cut a batch into runs of rows with about ``most`` bytes of text, at least one row each."""
    if not batch.num_rows:
        return
    offsets = buffers(batch.column(column))[1]
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def runs(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Positions start[i], start[i]+1, ... (count[i] of them) for all i, in order."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(count)
    return np.arange(total) + np.repeat(start - (ends - count), count)
