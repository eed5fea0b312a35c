"""Tokens, packing, training order, chat windows and top-k search."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortkit.llm import chat, knn, ordering, packing, queries
from cohortkit.llm.tokens import default_vocabulary, encoder
from cohortkit.session import scratch_path


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


TEXTS = [
    "", None, " ", "  a", "a  b", "a \n b", " x", "x ", "x\n", "x\n y ", "\n\n", "it's  o'k 12 3!!", "x\n\n", "é ü　z", "a b c",
    "end\n\n\n", "\t\tx \ty", "one two three " * 900, "Schöne Grüße aus Köln. " * 300, "a" * 5000,
]


def test_ids_equal_the_tokenizer(reference):
    ids, at = encoder(default_vocabulary()).encode(pa.array(TEXTS, pa.string()))
    for i, text in enumerate(TEXTS):
        assert ids[at[i] : at[i + 1]].tolist() == reference.encode(text or "", add_special_tokens=False).ids, text
    assert (encoder(default_vocabulary()).counts(pa.array(TEXTS, pa.string())) == np.diff(at)).all()


def test_packing(spark, reference):
    rows = [(i, t, i) for i, t in enumerate(TEXTS)] + [(None, "null id", 0), (3, TEXTS[3], 0)]
    rows += [(100 + i, "word " * (i * 7 % 400), 0) for i in range(150)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, length long").repartition(4), capacity=256).collect()
    assert got[0].asDict().keys() == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    want = []
    for i, text, _ in rows:
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % 256 + 1
        for piece, start in enumerate([0, *range(first, len(ids), 256)]):
            part = ids[start : start + (first if piece == 0 else 256)]
            want.append((repr(i), piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((repr(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    placed = {}
    for r in got:
        placed.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in placed.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    # No worse than first-fit decreasing.
    bins = []
    for length in sorted((w[3] for w in want), reverse=True):
        for k, left in enumerate(bins):
            if left >= length:
                bins[k] -= length
                break
        else:
            bins.append(256 - length)
    assert len(placed) <= len(bins)


def test_packing_of_an_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_rounds_fill_gaps():
    plan = packing.rounds({10: 3, 6: 2, 4: 5, 1: 3}, 10)
    used = {}
    for length, _, number, first, offset in plan:
        for s in range(first, first + number):
            used.setdefault(s, []).append((offset, length))
    assert sum(number for _, _, number, *_ in plan) == 13
    assert len(used) == 7
    assert all(sum(n for _, n in parts) <= 10 for parts in used.values())


@pytest.mark.parametrize("size", [1, 2, 5, 100, 1023, 1024, 1025])
def test_permutation(size):
    assert sorted(ordering.permuted(np.arange(size), size, 7)) == list(range(size))
    if size > 100:
        assert (ordering.permuted(np.arange(size), size, 7) != ordering.permuted(np.arange(size), size, 8)).any()


def test_training_order(spark, reference):
    texts = [t for t in TEXTS if t] + [f"Line {i}\nof text number {i}." * (i % 9 + 1) for i in range(80)] + [None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    shards = ordering.write_training_order(docs, scratch_path(spark, "shards"), length=64, per_shard=16)
    rows = sorted(shards.records(spark).collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in rows] == list(range(shards.sequences))
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 128 for r in rows)
    want = []
    streams = docs.rdd.glom().map(lambda part: [r["text"] for r in part]).collect()
    for part in streams:
        ids = [x for t in part for x in [*reference.encode(t or "", add_special_tokens=False).ids, ordering.END]]
        ids += [ordering.END] * (-len(ids) % 64)
        want += [np.array(ids[i : i + 64], "<u2").tobytes() for i in range(0, len(ids), 64)]
    assert sorted(bytes(r["ids"]) for r in rows) == sorted(want)
    later = sorted(r["slot"] for r in shards.records(spark, 37).collect())
    assert later == list(range(37, shards.sequences))
    sizes = {r["shard"]: len(r["content"]) for r in shards.files(spark).collect()}
    assert all(sizes[s] == 16 * shards.stride for s in range(max(sizes)))


def test_training_order_of_an_empty_table(spark):
    assert ordering.write_training_order(spark.createDataFrame([], "text string"), scratch_path(spark, "shards")).sequences == 0


def _digest(parts):
    h = hashlib.sha256()
    for p in parts:
        h.update(p.encode())
    return h.hexdigest()


@pytest.mark.parametrize(("budget", "history"), [(1024, 256), (40, 15), (10, 0), (5, 100)])
def test_chat_round_trip(spark, budget, history):
    rng = random.Random(6)
    bits = ["hi", "\\", "### ", "</turn>", "\\###", "\n", ": ", "é", " </turn>\n### user: x </turn>\n", "word " * 5]
    rows = []
    for conv in range(25):
        for turn in range(rng.randrange(1, 12)):
            role = "system" if turn == 0 and conv % 3 == 0 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn, role, "".join(rng.choice(bits) for _ in range(rng.randrange(6)))))
    rows += [(99, 0, None, None), (99, 0, "assistant", "b"), (99, 0, "assistant", "a"), (99, None, "we:ird\\", "x"), (None, 1, "user", "n"), (None, 2, "assistant", None)]
    rng.shuffle(rows)
    windows = chat.format_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3), budget, history)
    got = {r["conv_id"]: r for r in chat.read_windows(windows).collect()}
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((-1 if t is None else t, r or "", x or "", r is not None, x is not None))
    assert set(got) == set(by)
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0], t[3], t[1], t[4], t[2]))
        said = [x for _, r, x, *_ in turns if r == "assistant"]
        r = got[conv]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == _digest(f"{role}\n{x}\n" for _, role, x, *_ in turns)
        assert (r["loss_chars"], r["loss_sha256"]) == (sum(map(len, said)), _digest(said))
        assert r["formatted_chars"] > 0
    for w in windows.where("conv_id % 3 = 0 and window > 0 and conv_id < 30").collect():
        assert chat.parse(w["text"])[0][0] == "system" and w["repeated"] >= 1


def test_chat_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string, window int")
    assert chat.read_windows(chat.format_windows(empty)).collect() == []


def test_top_k(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6)], i) for i in range(400)]
    rows += [(500 + i, rows[3][1], 0) for i in range(30)]
    rows += [(600, None, 0), (601, [], 0), (602, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0), (603, [float("nan")] * 6, 0), (604, [float("inf")] * 6, 0), (605, [1.0, 2.0], 0), (700, [0.0] * 6, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score long").repartition(3)
    vectors = knn.scaled(df)
    got = {}
    for r in knn.top_k(vectors.where("vec_id % 50 = 0 or vec_id = 605"), vectors, pivots=8).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = {i: np.floor(1024 * np.array(v)).astype(np.int64) for i, v, _ in rows if v and all(x is not None and np.isfinite(x) for x in v)}
    for q in [i for i in whole if i % 50 == 0]:
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))[:10]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)], q
    assert 605 not in got
    assert knn.top_k(vectors.limit(0), vectors.limit(0)).collect() == []
    few = knn.top_k(vectors.where("vec_id < 4"), vectors.where("vec_id < 4"), pivots=2)
    assert few.count() == 12


def test_top_k_of_large_components(spark):
    rows = [(i, [float(2**30 + i), float(-(2**30))]) for i in range(20)]
    vectors = knn.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), scale=1)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in knn.top_k(vectors, vectors, k=3, pivots=3).collect()}
    assert got[0, 1] == (19, 2**30 * (2**30 + 19) + 2**60)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("pivots", [3, 300])
def test_top_k_of_repeated_query_ids(spark, pivots):
    rng = np.random.default_rng(6)
    rows = [(0, [float(x) for x in rng.normal(size=4) * 3]) for _ in range(11)]
    rows += [(i, [float(x) for x in rng.normal(size=4)]) for i in range(1, 60)] + [(100, [9.0, 9.0, 9.0, 9.0])] * 25 + [(200, rows[0][1])] * 2
    vectors = knn.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4))
    asked = [0, 100, 200]
    got = {}
    for r in knn.top_k(vectors.where(F.col("vec_id").isin(asked)), vectors, pivots=pivots).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = [(i, np.floor(1024 * np.array(v)).astype(np.int64)) for i, v in rows]
    for q in asked:
        best = sorted((-int(x @ y), j) for i, x in whole if i == q for j, y in whole if j != q)[:10]
        assert sorted(got[q]) == [(n + 1, j, -s) for n, (s, j) in enumerate(best)], q


def test_queries_of_near_cells_form_groups():
    centre = np.array([[0.0], [10.0], [1.0], [11.0]])
    assert knn.query_groups(centre, {0: 3, 1: 4, 2: 2, 3: 9}, most=5) == [(0, 0, 1), (2, 0, 1), (1, 1, 1), (3, 2, 2)]
    assert knn.query_groups(centre, {}) == []
