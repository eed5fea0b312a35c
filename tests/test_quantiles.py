import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.operators import ordering

SHAPES = {
    "steps": lambda rng: np.round(rng.exponential(size=3000), 1),
    "smooth": lambda rng: rng.normal(size=3001),
    "atom": lambda rng: np.where(rng.random(3000) < 0.6, 0.0, -rng.random(3000)),
    "one": lambda rng: np.array([2.5]),
    "zeros": lambda rng: np.array([-0.0, 0.0, 1.0, -1.0]),
    "ends": lambda rng: np.array([-np.inf, 1.0, 2.0, 3.0, np.inf]),
}


@pytest.mark.parametrize("buckets", [5000, 0, 100])
def test_quantiles_by_class_whatever_the_bounds(spark, monkeypatch, buckets):
    if not buckets:  # a sketch so poor that ranks lie outside its bounds
        monkeypatch.setattr(ordering, "_SKETCH", 3)
        buckets = 1000
    rng = np.random.default_rng(3)
    data = {name: make(rng) for name, make in SHAPES.items()}
    rows = [(name, float(v), None) for name, values in data.items() for v in values] + [(None, 1.0, 2.0), ("one", None, None)]
    df = spark.createDataFrame(rows, "kind string, v double, empty double").repartition(5)
    wanted = [0.0, 0.25, 0.5, 0.9, 1.0]
    with np.errstate(invalid="ignore"):
        got = {r["kind"]: r for r in ordering.exact_quantiles(df, ["v", "empty"], wanted, by=["kind"], buckets=buckets).collect()}
        assert set(got) == set(data) and all(r["feature"] == "v" and r["n"] == len(data[k]) for k, r in got.items())
        for name, values in data.items():
            if name != "ends":
                assert got[name]["quantiles"] == pytest.approx(np.quantile(values, wanted), abs=1e-12)
    assert got["ends"]["quantiles"][1:3] == [1.0, 2.0]


def test_quantiles_read_their_rows_twice(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    df = spark.range(1000).select(F.col("id").cast("double").alias("v")).mapInPandas(count, "v double")
    found = ordering.exact_quantiles(df, ["v"], [0.5]).collect()
    assert found[0]["quantiles"] == [499.5] and ordering.exact_quantiles(df.limit(0), ["v"], [0.5]).collect() == []
    assert seen.value == 2000
