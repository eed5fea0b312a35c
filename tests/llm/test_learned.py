"""Toxicity, language identification and n-gram scores: held-out quality, exact base scores, odd tables."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import language, scoring, toxicity
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, toxicity double"


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(8)
    rows = []
    for i in range(400):
        lang = ("aa", "bb")[i % 2]
        letters = "abcdeno" if lang == "aa" else "tuvwxio"
        words = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "vile", "nasty"]))
        rows.append((i, " ".join(words).capitalize() + ".", lang, toxic))
    return rows


def test_toxicity_learns_and_keeps_other_columns(spark, prose):
    docs = spark.createDataFrame([(i, t, lang, 0.0) for i, t, lang, _ in prose], DOCS)
    labels = spark.createDataFrame([(i, int(y)) for i, _, _, y in prose if i % 3], "doc_id long, toxic int")
    weights = toxicity.fit(docs, labels, l1=1.0)
    assert len(weights.at) < 3000
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs, weights).collect()}
    held = [i for i, *_ in prose if i % 3 == 0]
    right = [(got[i] >= 0.5) == prose[i][3] for i in held]
    assert np.mean(right) > 0.95
    assert toxicity.score(docs, weights).columns == ["doc_id", "text", "lang", "toxicity"]


def test_weights_are_those_of_plain_ftrl(spark, prose):
    docs = spark.createDataFrame([(i, t, lang, 0.0) for i, t, lang, _ in prose[:120]], DOCS).repartition(5)
    labels = spark.createDataFrame([(i, int(y)) for i, _, _, y in prose[:120]], "doc_id long, toxic int")
    rows = [(r["epoch"], r["toxic"], np.frombuffer(r["at"], "<i4").tolist()) for r in toxicity.training_rows(docs, labels, bits=12).collect()]
    wanted = sorted((int(y), len(set(toxicity.features(pa.array([t]), 12)[1].tolist()))) for _, t, _, y in prose[:120])
    for epoch in (0, 1):
        assert sorted((y, len(at)) for e, y, at in rows if e == epoch) == wanted
    assert [r[0] for r in rows] == [0] * 120 + [1] * 120
    assert [r[2] for r in rows[:120]] != [r[2] for r in rows[120:]]
    weights = toxicity.fit(docs, labels, bits=12, l1=0.5)
    plain, bias = brute.ftrl([r[1:] for r in rows], alpha=1.0, beta=1.0, l1=0.5, l2=1.0, toxic_weight=2.0)
    assert len(plain) > 50 and dict(zip(weights.at.tolist(), weights.value.tolist(), strict=True)) == pytest.approx(plain)
    assert weights.bias == pytest.approx(bias)


def test_toxicity_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, None, None), (None, "", "x", 1.0), (1, "a" * 300_000, "x", 1.0)], DOCS)
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (2, None), (3, 7)], "doc_id long, toxic int")
    weights = toxicity.fit(docs, labels)
    assert len(weights.at) == 0
    assert {round(r["toxicity"], 6) for r in toxicity.score(docs, weights).collect()} == {round(1 / (1 + math.exp(3)), 6)}
    assert toxicity.score(docs.limit(0), weights).collect() == []


def test_language(spark, prose):
    docs = spark.createDataFrame([(i, t, lang, 0.0) for i, t, lang, _ in prose], DOCS)
    model = language.fit(docs.where("doc_id % 3 <> 1"))
    assert model.languages == ["aa", "bb"]
    assert np.allclose(model.probability.sum(0), 1)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(docs, model).collect()}
    assert all(got[i][0] == lang for i, _, lang, _ in prose if i % 3 == 1)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 -- 3"), (4, "abcd" * 50_000), (None, "Abe cod")], "doc_id long, text string")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(odd, model).collect()}
    assert found[1] == found[2] == found[3] == ("und", 0.0)
    assert found[4][0] == found[None][0] == "aa"
    assert all(0 <= s <= 1 for _, s in found.values())
    empty = language.fit(docs.limit(0))
    assert [r["lang_pred"] for r in language.identify(odd, empty).collect()] == ["und"] * 5


def test_forward_recursion_sums_all_segmentations():
    known = ["a", "b", "ab", "ba", "aba"]
    lattice = language.Lattice(known)
    p = np.array([[0.1], [0.2], [0.3], [0.05], [0.15], [0.2]])

    def total(word):
        if not word:
            return 1.0
        out = 0.0
        for n in range(1, len(word) + 1):
            head = word[:n]
            if head in known:
                out += p[known.index(head), 0] * total(word[n:])
            elif n == 1:
                out += p[-1, 0] * total(word[n:])
        return out

    for word in ("aba", "abab", "bbx", "xaba"):
        ((_, codes),) = language.by_length([word])
        assert np.isclose(lattice.forward(codes, lattice.edges(codes), p)[-1, 0, 0], total(word))


def test_scores(spark, prose):
    rows = [(i, t) for i, t, *_ in prose[:120]] + [(500, None), (None, ""), (7, prose[7][1]), (501, "  A\tb c a ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model, scored = scoring.train_and_score(docs, F.coalesce(F.col("doc_id") % 4 != 1, F.lit(True)))
    counts = Counter()
    pairs, context = Counter(), Counter()
    for i, t in rows:
        if i is None or i % 4 != 1:
            tokens = ["<s>", *brute.words(t), "</s>"]
            counts.update(tokens[1:])
            pairs.update(zip(tokens, tokens[1:]))
            context.update(tokens[:-1])
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        tokens = ["<s>", *brute.words(t), "</s>"]
        base = [(counts[w] + 0.5) / (n + 0.5 * (v + 1)) for w in tokens[1:]]
        full = []
        for a, w, p in zip(tokens, tokens[1:], base):
            c = float(scoring.restored(scoring.quantise(np.array([pairs[a, w]])))[0])
            full.append((c + scoring.MASS * p) / (context[a] + scoring.MASS))
        want.append((repr(i), len(base), sum(w in counts for w in tokens[1:]), n, round(sum(map(math.log10, base)), 6), round(sum(map(math.log10, full)), 6)))
    got = [(repr(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in scored.collect()]
    assert sorted(got) == sorted(want)
    assert {r["kind"] for r in model.collect()} == {1, 2}


def test_scores_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert scoring.train_and_score(empty, F.lit(True))[1].collect() == []
    one = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    _, scored = scoring.train_and_score(one, F.lit(False))
    assert sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in scored.collect()) == [(1, 3, 0, 0), (2, 1, 0, 0)]


def test_elias_fano_and_trie(tmp_path):
    rng = np.random.default_rng(3)
    for size, bits in ((0, 10), (1, 1), (50, 56), (5000, 60), (300, 9)):
        values = np.sort(rng.integers(0, 1 << bits, size, dtype=np.uint64))
        assert (scoring.EliasFano.unpack(scoring.EliasFano.pack(values, bits)) == values).all()
    pairs = np.unique(rng.integers(0, 1 << 20, 4000, dtype=np.uint64))
    counts = rng.integers(1, 1000, len(pairs))
    path = tmp_path / "trie"
    path.write_bytes(scoring.Trie.build(pairs, counts, 12))
    trie = scoring.Trie.mapped(str(path))
    asked = np.arange(1 << 20, dtype=np.uint64)
    want = np.zeros(1 << 20, np.uint8)
    want[pairs.astype(np.int64)] = scoring.quantise(counts)
    assert (trie.lookup(asked) == want).all()
    restored = scoring.restored(scoring.quantise(np.arange(1, 5000)))
    assert (restored <= np.arange(1, 5000) + 1e-9).all() and (restored >= np.arange(1, 5000) / 1.1).all()
