"""Shingle join, components, suffix removal and benchmark phrases against brute force."""

import random
import tempfile
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import decontaminate, setjoin, suffix
from cohortkit.llm.components import connected_components
from cohortkit.llm.induced import repeated_windows
from cohortkit.llm.scoring import EliasFano
from tests.llm import brute

ODD = "doc_id long, text string, n long, component_id long, kept string, spans string"


@pytest.mark.parametrize(("k", "num", "den"), [(3, 90, 100), (5, 80, 100), (2, 60, 100)])
def test_components(spark, k, num, den):
    for seed in (5, 6):
        rows = brute.near_copies(seed)
        got = {r["doc_id"]: r for r in setjoin.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), k, num, den).collect()}
        want = brute.components(rows, k, num, den)
        assert {d: r["component_id"] for d, r in got.items()} == want
        assert {d: r["n_shingles"] for d, r in got.items()} == {d: len(brute.shingles(t, k)) for d, t in rows}


@pytest.mark.parametrize(("k", "num", "den"), [(3, 90, 100), (5, 80, 100)])
def test_near_copies_of_very_long_documents(spark, k, num, den):
    rng = random.Random(8)
    base = [f"w{rng.randrange(5000)}" for _ in range(20_500)]
    other = [f"w{rng.randrange(5000)}" for _ in range(20_500)]
    rows = [(1, " ".join(other))]
    for d, changed in ((5, 0), (3, 1), (9, 3), (7, 2000)):
        w = list(base)
        for at in rng.sample(range(len(w)), changed):
            w[at] = "x"
        rows.append((d, " ".join(w)))
    rows += [(11, " ".join(base[:19_400])), (12, " ".join(other[:300])), (13, " ".join(other[:299]))]
    got = setjoin.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), k, num, den).collect()
    want = brute.components(rows, k, num, den)
    assert want[9] == want[11] == 3 and want[13] == 12 and want[1] == 1
    assert {r["doc_id"]: r["component_id"] for r in got} == want


@pytest.mark.parametrize(("k", "num", "den", "changed"), [(3, 90, 100, 2), (5, 80, 100, 3)])
def test_copies_that_link_through_one_text_only_are_not_compared_in_pairs(spark, monkeypatch, k, num, den, changed):
    """Each copy differs from the common text by a little less than the rule allows, and from most others by more."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(3000)}" for _ in range(150)]
    rows, copies = [(7, " ".join(base))], 150
    for d in range(copies):
        w = list(base)
        for i, at in enumerate(rng.sample(range(5, 145), changed)):
            w[at] = f"x{d}of{i}"
        rows.append((100 + d, " ".join(w)))
    rows.append((1, " ".join(base[:100] + [f"y{i}" for i in range(50)])))
    compared, write = [], setjoin.materialise

    def counted(df, label):
        out = write(df, label)
        if label == "set-pairs":
            compared.append(out.count())
        return out

    monkeypatch.setattr(setjoin, "materialise", counted)
    got = setjoin.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), k, num, den).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute.components(rows, k, num, den)
    assert sum(compared) <= 4 * len(rows)


def test_light_sets_of_three_sizes_need_their_own_overlap():
    rule = setjoin.Rule(90, 100)
    assert (20, 19) in rule.partners(19, 40) and (18, 18) in rule.partners(20, 40)
    assert rule.partners(9, 40) == [(9, 9), (10, 9)]
    assert setjoin.Rule(80, 100).boundary({4: 10, 300: 5}) > 4


def test_components_of_odd_tables(spark):
    empty = spark.createDataFrame([], ODD)
    assert setjoin.components(empty).collect() == []
    rows = [(None, "a b c", 1, 2, "x", "y"), (4, "a b c", 1, 2, "x", "y"), (4, "a b c", 1, 2, "x", "y"), (2, "A B  C", 1, 2, "x", "y"), (9, None, 1, 2, "x", "y")]
    df = spark.createDataFrame(rows, ODD)
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in setjoin.components(df).collect())
    assert got == [(-1, 1, None), (2, 1, 2), (4, 1, 2), (4, 1, 2), (9, 0, 9)]
    kept = setjoin.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 2, 9]
    again = setjoin.keep_one(spark.createDataFrame([*rows[:1], *rows[3:], rows[3], (2, "z", 1, 2, "x", "y")], ODD))
    assert again.columns == df.columns
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in again.collect()) == [(-1, "a b c"), (2, "A B  C"), (2, "z"), (9, "")]


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, x) for x in range(300, 400)] + [(5, 5)]
    edges += [(rng.randrange(1000, 1060), rng.randrange(1000, 1060)) for _ in range(40)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


def test_induced_sorting_finds_repeated_windows():
    rng = np.random.default_rng(2)
    for trial in range(60):
        depth = int(rng.integers(2, 12))
        strings = [bytes(rng.integers(0, trial % 3 + 2, int(rng.integers(0, 60))).astype(np.uint8)) for _ in range(5)]
        strings += [strings[0], b"\1" * 30]
        raw = b"".join(bytes(x + 1 for x in s) + b"\0" for s in strings)
        allowed, want, at, seen = np.zeros(len(raw), bool), np.zeros(len(raw), bool), 0, {}
        for s in strings:
            for i in range(len(s) - depth + 1):
                allowed[at + i] = True
                seen.setdefault(s[i : i + depth], []).append(at + i)
            at += len(s) + 1
        for places in seen.values():
            want[places] = len(places) > 1
        with tempfile.TemporaryDirectory() as folder:
            path = f"{folder}/text"
            with open(path, "wb") as file:
                file.write(raw + bytes(depth + 8))
            assert (repeated_windows(path, len(raw), allowed, depth, folder) == want).all()


@pytest.mark.parametrize("length", [60, 200])
def test_repeats_are_cut(spark, length):
    rng = random.Random(3)
    syllables = ["ba", "né", "ti ", "ro", "ü", "la\n", "qu ", "e"]
    some = ["".join(rng.choice(syllables) for _ in range(rng.randrange(400))) for _ in range(25)]
    passage = "".join(rng.choice(syllables) for _ in range(160))
    texts = some + [some[0], some[1][:150] + "X" + some[1][150:], "a" * 500, "a" * 230, "", None, passage * 2]
    texts += [t[:90] + passage + t[90:] for t in some[2:9]]
    rows = [(i, t, i) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in suffix.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string, kept long").repartition(4), length).collect()}
    for (i, _, _), (spans, kept) in zip(rows, brute.repeats(texts, length), strict=True):
        assert bytes(got[i]["kept"]) == kept, i
        assert [(s["start"], s["length"]) for s in got[i]["spans"]] == spans
    whole = suffix.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string, other long"), length, whole_characters=True)
    assert whole.columns == ["doc_id", "text", "other", "spans", "kept"]
    for r in whole.collect():
        bytes(r["kept"]).decode()


@pytest.mark.parametrize(("piece", "many"), [(3000, 5), (3000, 1 << 20), (1 << 20, 5), (0, 0)])
def test_repeats_about_a_common_line(spark, piece, many):
    rng = random.Random(9)

    def noise(n):
        return "".join(rng.choice("abcdefghij é\n") for _ in range(n))

    line, passage = noise(70), noise(210)
    shared = [noise(60) + line + noise(90) for _ in range(3)]
    texts = [noise(rng.randrange(300)) + line + noise(rng.randrange(300)) for _ in range(40)]
    texts += [noise(100) + passage + noise(100) for _ in range(12)]
    texts += [noise(50) + s + noise(50) for s in shared for _ in range(2)] + [texts[0], line * 5, noise(500)]
    rows = list(enumerate(texts))
    got = suffix.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), piece=piece, many=many).collect()
    got = {r["doc_id"]: (([(s["start"], s["length"]) for s in r["spans"]]), bytes(r["kept"])) for r in got}
    assert got == dict(enumerate(brute.repeats(texts, 200)))


def test_a_shard_is_sorted_in_pieces_of_whole_grams(tmp_path):
    rng = np.random.default_rng(4)
    grams = rng.integers(-(1 << 62), 1 << 62, 300)[rng.integers(0, 300, 5000)]
    rows = pa.record_batch({"gram": pa.array(grams), "bytes": pa.array([bytes(300)] * 5000, pa.binary())})
    pieces = list(suffix._pieces((rows.slice(i, 500) for i in range(0, 5000, 500)), str(tmp_path), 200_000))
    of = [np.concatenate([b.column("gram").to_numpy() for b in p]) for p in pieces]
    assert len(of) > 5 and max(map(len, of)) * 300 < 250_000
    assert sorted(np.concatenate(of)) == sorted(grams)
    assert sum(len(np.unique(x)) for x in of) == len(np.unique(grams))
    assert not list(tmp_path.iterdir())


def test_a_gram_of_many_contexts_is_not_compared_in_one_place():
    prints = np.arange(50, dtype=np.uint64)
    frame = {"shard": [0], "block": ["b"], "keys": [EliasFano.pack(np.full(50, 7), 60)], "prints": [prints.tobytes()]}
    few, many = (np.frombuffer(zlib.decompress(suffix._judge(frame, n)["reply"][0]), np.uint8) for n in (50, 49))
    assert (few == 2).all() and (many == 4).all()


def test_anchors_spread_evenly_over_the_shards():
    rng = np.random.default_rng(3)
    texts = pa.array(["".join(map(chr, rng.integers(97, 123, 20_000))) for _ in range(20)])
    anchors = suffix._Anchors(texts, 200)
    sizes = [b - a for _, a, b in suffix._cuts(anchors.hash, 5)]
    assert sum(sizes) == len(anchors.hash) > 4000
    assert max(sizes) < 2 * len(anchors.hash) / 32
    assert (np.diff(anchors.hash.astype(float)) >= 0).all()


def test_anchors_are_judged_alike_by_ranges_of_keys(monkeypatch):
    rng = np.random.default_rng(8)
    keys = [np.sort(rng.integers(0, 300, n).astype(np.uint64) << np.uint64(40)) for n in (1, 400, 900, 50)]
    frame = pd.DataFrame({
        "shard": 0, "block": [f"0-{i}" for i in range(len(keys))], "keys": [EliasFano.pack(k, 59) for k in keys],
        "prints": [rng.integers(0, 4, len(k)).astype(np.uint64).tobytes() for k in keys]})
    largest, judge = [], suffix._judge_range
    monkeypatch.setattr(suffix, "_judge_range", lambda key, *rest: (largest.append(len(key)), judge(key, *rest))[1])
    replies = []
    for size in (1 << 18, 100):
        monkeypatch.setattr(suffix, "JUDGED", size)
        replies.append([zlib.decompress(r) for r in suffix._judge(frame, 3)["reply"]])
    assert largest[0] == 1351 and max(largest[1:]) < 300
    assert replies[0] == replies[1]



def test_repeats_in_an_empty_table(spark):
    assert suffix.cut_repeats(spark.createDataFrame([], ODD)).collect() == []
    assert suffix.cut_repeats(spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")).count() == 2


def test_phrases(spark):
    rng = random.Random(4)
    vocabulary = ["Of", "the", "a", *(f"w{i}é" for i in range(30))]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 25)))) for i in range(30)]
    items += [(40, items[0][1]), (41, ""), (42, None), (43, "--- !!"), (None, items[3][1]), (44, "w1é")]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60)))) for i in range(40)]
    docs += [(100 + i, f"x {t or ''}, {t or ''}! tail") for i, (_, t) in enumerate(items)] + [(None, items[1][1]), (7, items[2][1]), (7, None)]
    got = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string").withColumnRenamed("doc_id", "doc_id").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute.contamination(docs, items)))


def test_phrases_near_their_place(spark):
    docs = spark.createDataFrame([(1, "one two extra three four"), (2, "one two three four"), (3, "one four")], "doc_id long, text string")
    items = spark.createDataFrame([("i", "one two three four")], "item_id string, text string")
    index = decontaminate.build_index(docs)
    wanted = decontaminate.phrases(items)
    rows = {r["doc_row"]: r["doc_id"] for r in decontaminate.documents_of(index).collect()}
    assert [rows[r["doc_row"]] for r in decontaminate.find_phrases(index, wanted).collect()] == [2]
    assert sorted({rows[r["doc_row"]] for r in decontaminate.find_phrases(index, wanted, slop=1).collect()}) == [1, 2]


def test_phrases_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert decontaminate.contamination(docs, items).collect() == []
    assert [tuple(r)[:4] for r in decontaminate.contamination(some, items).collect()] == [(1, 2, 0, 0)]


def test_phrases_of_repeated_items_and_clashing_columns(spark):
    ten = "one two three four five six seven eight nine ten"
    items = [("a", ten), ("a", "three four five"), (None, ten + " eleven"), (None, "six seven"), ("b", "nine ten x"), ("a", ten)]
    docs = [(1, f"x {ten} x"), (2, f"three four five {ten}"), (None, "six seven"), (4, f"{ten} eleven y nine ten x"), (4, "three four"), (5, " ".join([ten] * 9))]
    schema = "doc_id long, text string, doc_row long, item_id string, low long, high long, term long, segment string, n_words long"
    got = decontaminate.contamination(
        spark.createDataFrame([(*d, 7, "q", 7, 7, 7, "s", 7) for d in docs], schema).repartition(3),
        spark.createDataFrame([(*i, 7, 7) for i in items], "item_id string, text string, doc_id long, terms long"))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute.contamination(docs, items)))


def test_phrases_in_a_text_beyond_one_segment(spark):
    filler = "zz yy xx " * 900_000
    docs = [(1, filler + "one two three " + filler), (2, "one two three")]
    items = [("i", "one two three"), ("j", "xx one two")]
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"))
    assert sorted(tuple(r)[:4] for r in got.collect()) == [(1, 5_400_003, 4, 2), (2, 3, 3, 1)]


@pytest.mark.parametrize(("num", "den"), [(90, 100), (80, 100), (60, 100)])
def test_listed_shingles_hold_what_linked_sets_share(spark, num, den):
    """Sets at the edge of the rule, listed and cut in two random orders, still meet."""
    rule, rng = setjoin.Rule(num, den), np.random.default_rng(4)
    sizes = np.arange(1, 400)
    cols = spark.range(1, 400).select(rule.listed_column(F.col("id")).alias("l"), rule.kept_column(F.col("id")).alias("k")).collect()
    listed, kept = (np.array([r[c] for r in cols]) for c in "lk")
    assert (listed == rule.listed(sizes)).all() and (kept >= 1).all() and (kept <= listed).all()
    for s in range(1, 400):
        t = int(rng.integers(rule.smallest(s), s + 1))
        if (c := rule.overlap(s, t)) > t:
            continue
        both, a, b = np.split(rng.permutation(4000)[: s + t - c], [c, s])
        one, two = rng.random(4000), rng.random(4000)
        cut = []
        for x in (np.concatenate([both, a]), np.concatenate([both, b])):
            first = x[np.argsort(one[x])][: listed[len(x) - 1]]
            cut.append(first[np.argsort(two[first])][: kept[len(x) - 1]])
        assert np.isin(*cut).any()
