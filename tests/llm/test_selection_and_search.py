"""Importance resampling, line dedup and ranked search against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import lines, resample, search
from cohortkit.llm.text import LETTERS, Words
from cohortkit.llm.vocabulary import encode, places
from tests.llm import brute

CLASHING = "doc_id long, text string, score long, rank long, weight long, gone string, place int, row long, n long, item_id long"


def some_docs(seed, n=70):
    rng = random.Random(seed)
    vocabulary = ["The", "of", "É", "naïve", "x1", "日本", *(f"w{i}" for i in range(60))]
    texts = [" ".join(rng.choices(vocabulary, weights=[30, 20, *[1] * 64], k=rng.randrange(90))) for _ in range(n)]
    texts += [texts[0]] * 15 + [texts[1].upper()] * 3 + ["", None, "--- ...", "of", "w3, w3! W3", " ".join(["of"] * 700) + " w3", "q" * 5000]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    return rows + [(5, "w1 w2 " * 30), (5, "w1 w2 " * 30), (None, "w4 of The " * 20), (None, None)]


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def frame(spark, rows, schema="doc_id long, text string", parts=5):
    return spark.createDataFrame(rows, schema).repartition(parts)


@pytest.mark.parametrize(("longest", "buckets", "often"), [(1, 10_000, 16), (1, 50, 1), (2, 997, 1), (3, 64, 2)])
def test_resample(spark, monkeypatch, longest, buckets, often):
    monkeypatch.setattr(resample, "_OFTEN", often)
    docs, target = some_docs(1), ["the w1 w2 É", "w3 of naïve 日本 w3", None, ""]
    got = resample.resample(
        frame(spark, docs), spark.createDataFrame([(t,) for t in target], "text string"), (30, 100), longest, buckets, 7, 10)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    same(map(tuple, got.drop("n_words").collect()), brute.resample(docs, target, (30, 100), longest, buckets, 7, 10))


def test_resample_does_not_depend_on_the_head(spark, monkeypatch):
    monkeypatch.setattr(resample, "_OFTEN", 1)
    docs = frame(spark, some_docs(2))
    none = resample.Head(pa.array([], pa.large_binary()), *(np.zeros(0, np.int64) for _ in range(3)))
    known = resample.head(docs, 2)
    assert len(known.words) > 20 and len(known.pairs) > 20
    few = resample.head(docs, 2, words=3, pairs=2)
    assert [bytes(w.as_py()) for w in few.words[:1]] == [b"of"] and len(few.pairs) <= 2
    totals = [resample.bucket_totals(docs, h, 2, 500).tolist() for h in (none, few, known)]
    assert totals[0] == totals[1] == totals[2]


def test_ranks_over_many_partitions_with_ties(spark):
    rows = [(i if i % 50 else None, 25 if i % 3 else 3, 25, 0, i % 11) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long").repartition(16)
    got = resample._ranked(df, (10, 100), 20).where("rank is not null").orderBy("rank").collect()
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    assert [(r["rank"], r["doc_id"], r["score"]) for r in got] == [(i + 1, r[0], r[4]) for i, r in enumerate(able[: len(able) // 10])]


def test_resample_odd_tables(spark):
    target = spark.createDataFrame([("a b",)], "text string")
    assert resample.resample(spark.createDataFrame([], CLASHING), target).collect() == []
    rows = [(1, "a " * 30, 9, 9, 9, "g", 9, 9, 9, 9), (1, None, 9, 9, 9, "g", 9, 9, 9, 9)]
    clashing = resample.resample(spark.createDataFrame(rows, CLASHING), target, (1, 1))
    assert sorted(map(tuple, clashing.select("doc_id", "n_features", "rank").collect()), key=str) == [(1, 0, None), (1, 30, 1)]
    nothing = resample.resample(spark.createDataFrame(rows, CLASHING), spark.createDataFrame([], "text string"), (1, 1))
    assert nothing.where("rank = 1").count() == 1


def line_docs(seed):
    rng = random.Random(seed)
    common = ["A line that stands in many documents, number %d é" % i for i in range(6)]
    other = ["short", "", "  ", "\x0b x \r", "another quite long line without any copy %d", "é" * 39, "é" * 40, "É" * 40, " " * 50]
    rows = []
    for i in range(60):
        some = [rng.choice(common) for _ in range(rng.randrange(4))] + [rng.choice(other).replace("%d", str(i)) for _ in range(rng.randrange(6))]
        some = [rng.choice(["", " ", "\t\x0c"]) + (x.upper().replace("É", "é") if rng.random() < 0.3 else x) + rng.choice(["", "\r", " "]) for x in some]
        rng.shuffle(some)
        rows.append((i * 5 % 211, "\n".join(some)))
    rows += [(300, None), (301, ""), (None, "\n".join(common)), (None, None), (7, common[0] + "\n" + common[0]), (7, common[0] + "\n" + common[0]), (7, "\n\n")]
    return rows + [(400 + i, common[0]) for i in range(200)]


@pytest.mark.parametrize(("least_chars", "least_docs"), [(40, 5), (1, 2), (40, 1), (41, 30)])
def test_repeated_lines(spark, least_chars, least_docs):
    for seed in (1, 2):
        rows = line_docs(seed)
        got = lines.drop_repeated_lines(frame(spark, rows), least_chars, least_docs)
        assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
        same(map(tuple, got.collect()), brute.repeated_lines(rows, least_chars, least_docs))


@pytest.mark.parametrize("hot", [1, 3, 1 << 40])
def test_hot_lines_take_the_other_join(spark, monkeypatch, hot):
    monkeypatch.setattr(lines, "_HOT", hot)  # none, some, and all of the repeated lines are hot
    rows = line_docs(3)
    same(map(tuple, lines.drop_repeated_lines(frame(spark, rows)).collect()), brute.repeated_lines(rows, 40, 5))


def test_lines_of_a_very_long_text(spark):
    line = "this line is repeated over and over again"
    rows = [(1, "\n".join([line, "x" * 3000] * 4000)), *((i, line) for i in range(2, 8))]
    got = {r["doc_id"]: r for r in lines.drop_repeated_lines(frame(spark, rows)).collect()}
    assert got[1]["n_lines"] == 8000 and got[1]["n_dropped"] == 4000
    assert got[7]["text"] == line and got[2]["text"] == ""


def test_lines_of_odd_tables(spark):
    assert lines.drop_repeated_lines(spark.createDataFrame([], CLASHING)).collect() == []
    rows = [(i, "x" * 50, 9, 9, 9, "g", 9, 9, 9, 9) for i in range(6)]
    got = lines.drop_repeated_lines(spark.createDataFrame(rows, CLASHING)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [*((i, "") for i in range(5)), (5, "x" * 50)]


ITEMS = [("a", "the w1 w1 naïve"), ("b", "W3, w4"), ("a", "日本 É"), (None, "of"), ("c", ""), ("d", None), ("e", "notthere"), ("f", "w5 w6 of the x1 w7 w8 q")]


@pytest.mark.parametrize(("k", "b", "block"), [(10, 75, 1 << 20), (3, 0, 1), (1, 100, 12)])
def test_search(spark, monkeypatch, k, b, block):
    monkeypatch.setattr(search, "_CELLS", 64 if k == 3 else 1 << 21)
    docs = some_docs(3)
    got = search.search(frame(spark, docs), spark.createDataFrame(ITEMS, "item_id string, text string"), k, b, block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    same(map(tuple, got.collect()), brute.search(docs, ITEMS, k, b))


def test_search_of_large_classes(spark):
    docs = [(i, "w1 w2 zz") for i in range(500, 0, -1)] + [(1000 + i, "w1 w2 yy") for i in range(500)] + [(None, "w1 w2 zz")] * 3
    items = [(1, "w1"), (2, "w2 w2"), (3, "yy")]
    got = search.search(frame(spark, docs, parts=13), spark.createDataFrame(items, "item_id long, text string"), 10)
    same(map(tuple, got.collect()), brute.search(docs, items, 10, 75))


def test_search_odd_tables(spark):
    nothing, some = spark.createDataFrame([], CLASHING), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    docs = spark.createDataFrame([(4, "a", 9, 9, 9, "g", 9, 9, 9, 9), (None, None, 9, 9, 9, "g", 9, 9, 9, 9)], CLASHING)
    assert search.search(nothing, some).collect() == []
    assert search.search(docs, spark.createDataFrame([], "item_id long, text string")).collect() == []
    got = search.search(docs, docs.select(F.lit(8).alias("item_id"), "text", "rank", "score")).collect()
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in got] == [(8, 1, 4)]


@pytest.mark.parametrize("wide", [False, True])
def test_bags_unpack_as_they_were_packed(wide):
    rng = np.random.default_rng(1)
    row = np.sort(rng.integers(0, 9, 200))
    term = rng.integers(0, 1 << (30 if wide else 16), 200)
    often = np.where(rng.random(200) < 0.2, rng.integers(250, 1 << 40, 200), rng.integers(1, 256, 200))
    bags, sizes = search.pack_bags(row, term, often, 11, wide)
    for got, want in zip(search.unpack_bags(bags, sizes, wide), (row, term, often), strict=True):
        assert (got == want).all()


def test_vocabulary_is_exact():
    words = Words(pa.array(["b A, b", None, "", "é a"]), LETTERS)
    distinct, code = encode(words)
    assert [distinct[i].as_py().decode() for i in code.tolist()] == ["b", "a", "b", "é", "a"]
    assert places(distinct, pa.array([b"a", b"zz"], pa.large_binary())).tolist() == [-1, 0, -1]
    assert places(distinct, pa.array([], pa.large_binary())).tolist() == [-1, -1, -1]
