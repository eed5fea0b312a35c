"""Token ids of whole Arrow batches with the public byte-level BPE vocabulary.

The rank file and the JSON file of the vocabulary give the same ids (a test
compares them); the rank file's encoder is several times faster. A text is cut
before every blank that a non-blank follows. The vocabulary's pattern never
joins tokens over such a cut, so each distinct unit of a batch is encoded once.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cohortkit.llm.text import buffers, runs

# A blank before another white-space character: such texts are encoded whole.
_ODD = r" [\s\v\p{Z}\x{85}\x{1c}-\x{1f}]"


def default_vocabulary() -> str:
    """Place of the public rank file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Encoder:
    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._coder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self._bytes[rank] = len(token)
        self._blank = np.array(self._coder.encode_ordinary(" "), np.uint16)

    def _units(self, texts: pa.Array):
        """Distinct units of the batch and, per row, which ones: (ids, start and count of each unit, units, units per row)."""
        if texts.null_count:
            texts = texts.fill_null("")
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        plain = texts if not odd.any() else pc.if_else(pa.array(~odd), texts, pa.scalar("", texts.type))
        parts = pc.split_pattern(plain, pattern=" ")
        offsets = parts.offsets.to_numpy().astype(np.int64)
        coded = pc.dictionary_encode(parts.flatten())
        offsets = offsets - offsets[0]
        words, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_py()
        ids = np.array(self._coder.encode_ordinary(" " + joined) if len(words) else [], np.uint16)
        lengths = np.diff(buffers(words)[1]) + 1
        ends = np.searchsorted(np.cumsum(self._bytes[ids]), np.cumsum(lengths)) + 1
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        counts = ends - starts
        # An empty word follows the last blank of a text, or stands before the first one.
        pieces, at = [ids, self._blank], len(ids) + len(self._blank)
        empty = pc.index(words, "").as_py()
        if empty >= 0:
            starts[empty], counts[empty] = len(ids), len(self._blank)
        # The first word of a text has no blank before it; odd texts are one unit each.
        extra_start, extra_count, seen = [], [], {}
        per_row = np.diff(offsets)
        heads = np.zeros(len(texts), np.int64)
        heads[per_row > 0] = codes[offsets[:-1][per_row > 0]]
        source = words.take(pa.array(heads)).to_pylist() if len(words) else [""] * len(texts)
        for row in np.flatnonzero(odd):
            source[row] = texts[int(row)].as_py()
        place = np.empty(len(source), np.int64)
        for row, unit in enumerate(source):
            known = seen.get(unit)
            if known is None:
                got = self._coder.encode_ordinary(unit)
                known = seen[unit] = len(extra_start)
                extra_start.append(at)
                extra_count.append(len(got))
                pieces.append(np.array(got, np.uint16))
                at += len(got)
            place[row] = len(words) + known
        codes = codes.copy()
        codes[offsets[:-1][per_row > 0]] = place[per_row > 0]
        return (
            np.concatenate(pieces), np.concatenate([starts, np.array(extra_start, np.int64)]).astype(np.int64),
            np.concatenate([counts, np.array(extra_count, np.int64)]).astype(np.int64), codes, offsets,
        )

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text; a null is an empty text."""
        _, _, count, codes, offsets = self._units(texts)
        total = np.concatenate([[0], np.cumsum(count[codes])])
        return total[offsets[1:]] - total[offsets[:-1]]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text starts (one more at the end)."""
        ids, start, count, codes, offsets = self._units(texts)
        taken = count[codes]
        total = np.concatenate([[0], np.cumsum(taken)])
        return ids[runs(start[codes], taken)], total[offsets]
