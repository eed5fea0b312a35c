import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.operators.cleaning import label_codes
from cohortkit.operators.ordering import cut_by_rank, exact_quantiles, running, shuffle_token


@pytest.mark.parametrize("buckets", [1, 16, None])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, buckets, descending):
    rng = np.random.default_rng(1)
    # Half of the distinct values crowd into a thousandth of the range.
    keys = np.unique(np.concatenate([rng.random(200) / 1000, rng.random(200)]))
    add = rng.integers(1, 9, len(keys))
    df = spark.createDataFrame([(float(k), int(a)) for k, a in zip(keys, add)], "k double, a int")
    out = running(
        df, "k", {"total": ("sum", "a"), "low": ("min", "a"), "high": ("max", "a")},
        descending=descending, buckets=buckets,
    ).orderBy("k").collect()
    walk = add[::-1] if descending else add
    expected = list(zip(np.cumsum(walk), np.minimum.accumulate(walk), np.maximum.accumulate(walk)))
    if descending:
        expected = expected[::-1]
    assert [(r["total"], r["low"], r["high"]) for r in out] == [tuple(map(int, e)) for e in expected]


@pytest.mark.parametrize("buckets", [8, 256])
def test_quantiles_match_numpy_with_hot_values_and_groups(spark, buckets):
    rng = np.random.default_rng(2)
    groups = {
        "hot": np.concatenate([np.full(900, 7.0), rng.normal(size=300)]),
        "wide": np.exp(rng.normal(size=501) * 8),
        "one": np.array([3.5]),
        "same": np.full(20, 0.1),
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("hot", None), ("hot", float("nan")), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    wanted = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {
        r["g"]: (r["n"], r["quantiles"])
        for r in exact_quantiles(df, ["v"], wanted, by=["g"], buckets=buckets).collect()
    }
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g][0] == len(values)
        assert got[g][1] == pytest.approx(list(np.quantile(values, wanted)), rel=1e-12)


def test_cuts_are_exact_for_a_class_with_most_rows(spark):
    rows = [(i, 1 if i % 10 else 0) for i in range(3000)] + [(9000, 2), (9001, None)]
    df = spark.createDataFrame(rows, "k bigint, y int")
    cut = cut_by_rank(df, "k", "y", [0.2, 0.5], shuffle_token("k", 3), "part")
    counts = {(r["y"], r["part"]): r["count"] for r in cut.groupBy("y", "part").count().collect()}
    assert (counts[(1, 0)], counts[(1, 1)]) == (540, 810)
    assert (counts[(0, 0)], counts[(0, 1)], counts[(0, 2)]) == (60, 90, 150)
    assert cut.where("y = 2").count() == 1 and cut.where("y IS NULL AND part IS NULL").count() == 1
    again = cut_by_rank(df.repartition(5), "k", "y", [0.2, 0.5], shuffle_token("k", 3), "part")
    assert cut.exceptAll(again).isEmpty()


def test_cut_orders_ties_of_the_token_by_key(spark):
    df = spark.range(10).select(F.col("id").alias("k"), F.lit(0).alias("y"))
    cut = cut_by_rank(df, "k", "y", [0.3], F.lit(5), "part")
    assert sorted(r["k"] for r in cut.where("part = 0").collect()) == [0, 1, 2]


@pytest.mark.parametrize("buckets", [1, 8, None])
def test_label_codes_sort_like_bytes(spark, buckets):
    labels = [f"patient_{i}" for i in range(150)] + ["patient_", "pat", "pät", "patient_1é", "zz"]
    df = spark.createDataFrame([(v,) for v in labels * 2] + [(None,)], "v string")
    codes = {r["value"]: r["code"] for r in label_codes(df, "v", buckets=buckets).collect()}
    assert codes == {v: i for i, v in enumerate(sorted(labels, key=lambda s: s.encode()))}
