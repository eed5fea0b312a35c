"""Exact vocabularies of Arrow batches: distinct words as bytes, and look-ups in a shared list."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cohortkit.llm.text import Words


def encode(words: Words) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of a batch as bytes, and for each word the number of its distinct one."""
    lengths = words.ends - words.starts
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    letters = np.ascontiguousarray(words.data[words.kept])
    spelled = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
    coded = spelled.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def places(distinct: pa.Array, listed: pa.Array) -> np.ndarray:
    """Where each word stands in ``listed``, compared byte by byte; -1 for a word that does not."""
    if not len(listed):
        return np.full(len(distinct), -1, np.int64)
    return pc.index_in(distinct, value_set=listed).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
