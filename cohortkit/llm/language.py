"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary
(and a small one for every single character). The probability of a word is
the sum over all ways to cut it into pieces, computed by the forward recursion;
a text's score is the sum over its words. The piece probabilities are fitted by
expectation-maximisation, whose expected counts come from the same recursion
run in both directions. Words, not texts, go through the recursion: each
distinct word of a batch once, all of one length side by side.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.text import mix, slices
from cohortkit.session import materialise

#: Most labelled documents of a language that the fit reads, chosen by hash.
FIT_DOCUMENTS = 4000
#: Longest piece in characters, and characters of a word beyond which it is cut into parts.
PIECE, WORD = 8, 32
_WORDS = r"[^\p{L}]+"


def default_vocabulary() -> str:
    """Place of the public piece model."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def pieces(path: str) -> list[str]:
    """Lower-case letter pieces of the vocabulary, at most ``PIECE`` characters long."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    raw = (model.id_to_piece(i).strip("▁").lower() for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)))
    return sorted({p for p in raw if 0 < len(p) <= PIECE and p.isalpha()})


class Lattice:
    """Pieces by hash, and the recursions over words of equal length."""

    def __init__(self, vocabulary: list[str]):
        hashes = [self._key(np.array([list(map(ord, p))], np.uint64), 0, len(p))[0] for p in vocabulary]
        order = np.argsort(np.array(hashes, np.uint64))
        self.keys, self.ids = np.array(hashes, np.uint64)[order], order
        self.size = len(vocabulary)

    @staticmethod
    def _key(codes: np.ndarray, start: int, length: int) -> np.ndarray:
        h = np.zeros(len(codes), np.uint64)
        for i in range(start, start + length):
            h = mix(h * np.uint64(31) + codes[:, i])
        return h

    def edges(self, codes: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
        """(start, length, piece of each word or ``size`` where there is none); one character always has an edge."""
        out = []
        for start in range(codes.shape[1]):
            key = np.zeros(len(codes), np.uint64)
            for length in range(1, min(PIECE, codes.shape[1] - start) + 1):
                key = mix(key * np.uint64(31) + codes[:, start + length - 1])
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                piece = np.where(self.keys[at] == key, self.ids[at], self.size)
                if length == 1 or (piece < self.size).any():
                    out.append((start, length, piece))
        return out

    def forward(self, codes: np.ndarray, edges, probability: np.ndarray) -> np.ndarray:
        """Sum over the segmentations of every prefix: (positions, words, languages).

        ``probability`` has a row for each piece and a last one for a character without a piece.
        """
        alpha = np.zeros((codes.shape[1] + 1, len(codes), probability.shape[1]))
        alpha[0] = 1
        for start, length, piece in edges:
            p = probability[piece]
            if length > 1:
                p = np.where((piece < self.size)[:, None], p, 0)
            alpha[start + length] += alpha[start] * p
        return alpha

    def expected(self, codes: np.ndarray, weights: np.ndarray, edges, probability: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over words seen ``weights`` times (one language)."""
        alpha = self.forward(codes, edges, probability)[:, :, 0]
        beta = np.zeros_like(alpha)
        beta[-1] = 1
        counts = np.zeros(self.size + 1)
        for start, length, piece in reversed(edges):
            p = probability[piece, 0]
            if length > 1:
                p = np.where(piece < self.size, p, 0)
            beta[start] += p * beta[start + length]
        total = np.maximum(alpha[-1], 1e-300)
        for start, length, piece in edges:
            p = probability[piece, 0]
            if length > 1:
                p = np.where(piece < self.size, p, 0)
            np.add.at(counts, piece, weights * alpha[start] * p * beta[start + length] / total)
        return counts


def by_length(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(which words, their code points as a matrix), one entry per word length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    out = []
    for n in np.unique(lengths[lengths > 0]):
        which = np.flatnonzero(lengths == n)
        joined = "".join([words[i] for i in which]).encode("utf-32-le", "surrogatepass")
        out.append((which, np.frombuffer(joined, "<u4").reshape(-1, n).astype(np.uint64)))
    return out


def _parts(flat: pa.Array) -> pa.Array:
    """Words longer than ``WORD`` characters become several parts; nothing is left out."""
    if not len(flat) or pc.max(pc.utf8_length(flat)).as_py() <= WORD:
        return flat
    return pa.array([w[i : i + WORD] for w in flat.to_pylist() for i in range(0, max(1, len(w)), WORD)], pa.string())


def words_of(texts: pa.Array) -> pa.ListArray:
    """Lower-case runs of letters of each text."""
    return pc.split_pattern_regex(pc.utf8_lower(texts.fill_null("")), pattern=_WORDS)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    pieces: list[str]
    probability: np.ndarray


def fit(labelled: DataFrame, vocabulary: str | None = None, documents: int = FIT_DOCUMENTS, steps: int = 4) -> Model:
    """Fit from ``labelled`` (text, lang): at most ``documents`` texts of a language, those with the smallest text hash.

    Rows with a null text or lang do not count. No usable row gives a model without languages.
    """
    vocabulary = vocabulary or default_vocabulary()
    known = pieces(vocabulary)
    rows = labelled.where("text is not null and lang is not null").select("lang", F.xxhash64("text").alias("h"), "text")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    # The cut by hash comes before any text moves: the limit of a language is found on (lang, h) alone.
    limit = rows.select("lang", "h").withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(
        F.col("r") <= documents).groupBy("lang").agg(F.max("h").alias("top"))
    chosen = rows.join(limit, "lang").where("h <= top").withColumn("r", rank).where(F.col("r") <= documents)

    def count(batches):
        for batch in batches:
            listed = words_of(batch.column("text"))
            lang = batch.column("lang").take(listed.value_parent_indices())
            table = pa.table({"lang": lang, "word": listed.flatten()}).group_by(["lang", "word"]).aggregate([([], "count_all")])
            for part in table.rename_columns(["lang", "word", "n"]).to_batches():
                yield part

    words = chosen.select("lang", "text").mapInArrow(count, "lang string, word string, n long").where("word <> ''")
    counted = words.groupBy("lang", "word").agg(F.sum("n").cast("long").alias("n"))

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        lattice = Lattice(known)
        words, n = [], []
        for word, times in zip(frame["word"], frame["n"], strict=True):
            for i in range(0, len(word), WORD):
                words.append(word[i : i + WORD])
                n.append(times)
        n = np.array(n, float)
        groups = [(n[which], codes, lattice.edges(codes)) for which, codes in by_length(words)]
        p = np.full((lattice.size + 1, 1), 1.0 / (lattice.size + 1))
        for _ in range(steps):
            counts = sum(lattice.expected(codes, weights, edges, p) for weights, codes, edges in groups)
            p[:, 0] = (counts + 0.01) / (counts.sum() + 0.01 * len(p))
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "p": [p[:, 0].tolist()]})

    fitted = sorted(counted.groupBy("lang").applyInPandas(learn, "lang string, p array<double>").collect(), key=lambda r: r["lang"])
    table = np.array([r["p"] for r in fitted]).T if fitted else np.zeros((len(known) + 1, 0))
    return Model([r["lang"] for r in fitted], known, table)


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of ``docs`` (text), and lang_pred, score.

    ``score`` is the posterior of the predicted language (equal priors). A null
    text, or one without letters, is ``und`` with score 0; so is every text when the model has no language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def score(batches):
        model = shared.value
        lattice = Lattice(model.pieces)
        names = np.array([*model.languages, "und"], object)
        known: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch in slices(whole, "text"):
                listed = words_of(batch.column("text").cast(pa.string()))
                row = listed.value_parent_indices().to_numpy(zero_copy_only=False)
                flat = listed.flatten()
                lengths = pc.utf8_length(flat).to_numpy(zero_copy_only=False)
                coded = flat.dictionary_encode()
                distinct = coded.dictionary.to_pylist()
                logs = np.zeros((len(distinct), len(model.languages)))
                new = []
                for i, w in enumerate(distinct):
                    at = known.get(w)
                    if at is None:
                        new.append(i)
                    else:
                        logs[i] = at
                parts = [(i, distinct[i][k : k + WORD]) for i in new for k in range(0, len(distinct[i]), WORD)]
                owner = np.array([i for i, _ in parts], np.int64)
                for which, codes in by_length([w for _, w in parts]):
                    for low in range(0, len(which), 20_000):
                        some, letters = which[low : low + 20_000], codes[low : low + 20_000]
                        total = lattice.forward(letters, lattice.edges(letters), model.probability)[-1]
                        np.add.at(logs, owner[some], np.log(np.maximum(total, 1e-300)))
                if len(known) < 150_000:
                    known.update((distinct[i], logs[i]) for i in new)
                sums = np.zeros((batch.num_rows, len(model.languages)))
                word_logs = logs[coded.indices.to_numpy()]
                for k in range(len(model.languages)):
                    sums[:, k] = np.bincount(row, word_logs[:, k], batch.num_rows)
                letters = np.bincount(row, lengths, batch.num_rows)
                if model.languages:
                    best = sums.argmax(1)
                    with np.errstate(under="ignore"):
                        posterior = 1 / np.exp(sums - sums.max(1, keepdims=True)).sum(1)
                else:
                    best, posterior = np.zeros(len(sums), int), np.zeros(len(sums))
                none = (letters == 0) | (len(model.languages) == 0)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in keep), pa.array(names[np.where(none, len(names) - 1, best)], pa.string()),
                     pa.array(np.where(none, 0.0, posterior))], names=[*keep, "lang_pred", "score"])

    chosen = docs.select(*keep, F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(score, f"{schema}, lang_pred string, score double")
