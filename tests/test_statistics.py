import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.functions.tails import chi2_tail, t_tail
from cohortkit.operators import correlation, distribution, hypothesis, selection, snp, temporal


@pytest.mark.parametrize("x, df, p", [
    (3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05),
    (18.307038053275146, 10, 0.05), (124.34211340400407, 100, 0.05), (0.0, 3, 1.0),
])
def test_chi_square_tail(x, df, p):
    assert chi2_tail(x, df) == pytest.approx(p, rel=1e-9)


@pytest.mark.parametrize("t, df, p", [
    (12.706204736432095, 1, 0.05), (4.302652729911275, 2, 0.05), (2.2281388519649385, 10, 0.05),
    (1.9839715184496334, 100, 0.05), (0.0, 5, 1.0), (-2.2281388519649385, 10, 0.05),
    (1.959963984540054, 1e12, 0.05),
])
def test_student_tail(t, df, p):
    assert t_tail(t, df) == pytest.approx(p, rel=1e-8)


def test_student_tail_is_smooth_where_the_method_changes():
    for edge in (2e4, 1e7):
        assert t_tail(2.5, edge * 0.999999) == pytest.approx(t_tail(2.5, edge * 1.000001), rel=1e-7)


def _cells(spark, cells):
    rows = [(float(lv), y) for (lv, y), n in cells.items() for _ in range(n)]
    return spark.createDataFrame(rows + [(None, 1)], "v double, y int")


def test_two_by_two_gets_yates(spark):
    df = _cells(spark, {(0, 0): 12, (0, 1): 5, (1, 0): 3, (1, 1): 10})
    row = hypothesis.chi_square(hypothesis.level_counts(df, {"v": F.col("v")}, "y")).first()
    n, gap = 30, abs(12 * 10 - 5 * 3) - 15
    expected = n * gap * gap / (17 * 13 * 15 * 15)
    assert row["statistic"] == pytest.approx(expected)
    assert row["p_value"] == pytest.approx(math.erfc(math.sqrt(expected / 2)))
    assert (row["n"], row["levels"], row["dof"]) == (30, 2, 1)


def test_zero_cells_count_and_single_levels_are_undefined(spark):
    df = _cells(spark, {(0, 0): 4, (1, 1): 6, (2, 0): 2})
    row = hypothesis.chi_square(hypothesis.level_counts(df, {"v": F.col("v"), "one": F.lit(1)}, "y")).orderBy("feature")
    one, v = row.collect()
    assert v["statistic"] == pytest.approx(12.0) and v["dof"] == 2
    assert one["statistic"] is None and one["p_value"] is None


def test_fractional_dosages_are_left_out_of_the_scan(spark):
    rows = [(i, d, y) for i, (d, y) in enumerate([(0.0, 0)] * 9 + [(1.0, 1)] * 8 + [(2.0, 1)] * 3 + [(0.7, 0)] * 50)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "patient_id int, rs1 double, diabetes int, rs2 double")
    scan = snp.association(snp.snp_cube(df)).collect()
    assert [r["snp"] for r in scan] == ["rs1"]  # rs2 has one level only
    assert scan[0]["statistic"] == pytest.approx(20.0) and scan[0]["dof"] == 2


def test_scan_without_testable_snps_is_empty(spark):
    df = spark.createDataFrame([(1, 1.0, 0), (2, 1.0, 1)], "patient_id int, rs1 double, diabetes int")
    assert snp.snp_association(df).isEmpty() and snp.significant_snps(df).isEmpty()
    with pytest.raises(ValueError, match="no SNP"):
        snp.snp_association(df.drop("rs1"))


def test_unknown_targets_count_in_frequencies_only(spark):
    df = spark.createDataFrame([(0.0, None), (1.0, 1), (2.0, 0), (2.0, 1)], "rs1 double, diabetes int")
    cube = snp.snp_cube(df)
    assert snp.genotype_frequencies(cube).first()["freq_0"] == 0.25
    shares = {(r["dosage"], r["target"]): r["share"] for r in snp.genotype_outcome_shares(cube).collect()}
    assert sum(shares.values()) == pytest.approx(1.0) and shares[(0, 0)] == 0


def test_allele_frequency_folds(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (1.0,)], "rs1 double")
    assert snp.minor_allele_frequency(df).first()["maf"] == pytest.approx(1 / 6)


@pytest.mark.parametrize("buckets", [1, 4, None])
def test_false_discovery_adjustment(spark, buckets):
    p = [0.01, 0.02, 0.02, 0.04, 0.5, 0.9, 0.9, None]
    df = spark.createDataFrame(list(enumerate(p)), "id int, p_value double")
    out = hypothesis.fdr_adjust(df, buckets=buckets).orderBy("id").collect()
    known = [v for v in p if v is not None]
    order, m, low = sorted(range(len(known)), key=lambda i: known[i]), len(known), 1.0
    expected = [0.0] * m
    for rank in range(m, 0, -1):
        i = order[rank - 1]
        low = min(low, known[i] * m / rank)
        expected[i] = low
    assert [r["p_fdr"] for r in out[:-1]] == pytest.approx(expected)
    assert out[-1]["p_fdr"] is None and not out[-1]["significant"]
    assert all(r["p_fdr"] >= r["p_value"] for r in out[:-1])


def test_welch_by_hand_and_too_few_rows(spark):
    rows = [(1.0, 5.0, 0), (2.0, 5.0, 0), (4.0, None, 0), (7.0, 5.0, 1), (9.0, 5.0, 1)]
    df = spark.createDataFrame(rows, "v double, w double, y int").withColumn("few", F.when(F.col("y") == 1, F.col("v")))
    out = {r["feature"]: r for r in hypothesis.welch_test(df, ["v", "w", "few"], "y").collect()}
    assert set(out) == {"v", "w"}
    a, b = np.array([1, 2, 4.0]), np.array([7, 9.0])
    sa, sb = a.var(ddof=1) / 3, b.var(ddof=1) / 2
    assert out["v"]["statistic"] == pytest.approx((a.mean() - b.mean()) / math.sqrt(sa + sb))
    assert out["v"]["dof"] == pytest.approx((sa + sb) ** 2 / (sa**2 / 2 + sb**2 / 1))
    assert out["w"]["statistic"] is None and out["w"]["p_value"] is None


def test_screen_adjusts_both_families_together(spark):
    rng = np.random.default_rng(3)
    rows = [
        (i, int(y), float(rng.normal() + y), int(rng.integers(0, 3)), int(rng.integers(0, 2)), int(i % 2), int(i % 2 == 0), "t")
        for i, y in enumerate(rng.integers(0, 2, 200))
    ]
    df = spark.createDataFrame(
        rows, "patient_id int, diabetes int, bmi double, rs1 int, gender int, raceasian int, raceother int, location string"
    )
    out = {r["feature"]: r for r in hypothesis.feature_screen(df).collect()}
    assert {k: r["test_group"] for k, r in out.items()} == {"bmi": "ttest", "rs1": "chi2", "gender": "chi2", "race": "chi2"}
    assert out["bmi"]["p_fdr"] == pytest.approx(min(1, out["bmi"]["p_value"] * 4))


def test_correlations_are_pairwise_complete(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 3)) + 1e6
    x[:, 1] += x[:, 0]
    rows = [(float(a), float(b), None if i % 4 == 0 else float(c), 0.1) for i, (a, b, c) in enumerate(x)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double").repartition(4)
    got = {
        (r["feature_a"], r["feature_b"]): r["r"]
        for r in correlation.correlation_pairs(df, ["a", "b", "c", "k"]).collect()
    }
    keep = np.arange(60) % 4 != 0
    assert got["a", "b"] == pytest.approx(np.corrcoef(x[:, 0], x[:, 1])[0, 1], abs=1e-9)
    assert got["a", "c"] == pytest.approx(np.corrcoef(x[keep, 0], x[keep, 2])[0, 1], abs=1e-9)
    assert got["a", "k"] is None and len(got) == 6


@pytest.mark.parametrize("state_bytes", [correlation.STATE_BYTES, 500])
def test_blocks_cover_every_pair(spark, monkeypatch, state_bytes):
    monkeypatch.setattr(correlation, "BLOCK", 2)
    monkeypatch.setattr(correlation, "STATE_BYTES", state_bytes)  # 500 bytes: two columns a scan
    rng = np.random.default_rng(5)
    data = rng.normal(size=(40, 5))
    names = list("abcde")
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], names)
    got = correlation.correlation_matrix(df, names).collect()
    full = np.corrcoef(data.T)
    assert len(got) == 25
    for r in got:
        assert r["r"] == pytest.approx(full[names.index(r["feature_a"]), names.index(r["feature_b"])], abs=1e-9)
    crossed = correlation.cross_correlations(df, names[:3], names[2:]).collect()
    assert len(crossed) == 9
    for r in crossed:
        assert r["r"] == pytest.approx(full[names.index(r["feature_a"]), names.index(r["feature_b"])], abs=1e-9)
    limit = float(np.median(np.abs(full[np.triu_indices(5, 1)])))
    beyond = correlation.correlation_pairs(df, names, above=limit).collect()
    assert {(r["position_a"], r["position_b"]) for r in beyond} == {
        (i, j) for i in range(5) for j in range(i + 1, 5) if abs(full[i, j]) > limit + 1e-12
    }


def test_one_scan_serves_all_pairs(spark, tmp_path):
    names = [f"c{i}" for i in range(600)]  # more than one block
    spark.range(20).select(*[((F.col("id") * (i + 3)) % 17).cast("double").alias(c) for i, c in enumerate(names)]).write.parquet(f"{tmp_path}/t")
    pairs = correlation.correlation_pairs(spark.read.parquet(f"{tmp_path}/t"), names, above=0.5)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1


def test_selection_rules(spark):
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 400)
    a = y + rng.normal(size=400) * 0.5
    snp1 = np.clip(y + rng.integers(0, 2, 400), 0, 2)
    rows = [
        (float(a[i]), float(a[i] + 1e-3 * rng.normal()), float(a[i] * 2), float(rng.normal()), 1.0,
         float(snp1[i]), float(snp1[i]), 1.0, float(rng.integers(0, 3)), int(y[i]))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, ["a", "b", "c", "noise", "steady", "rs1", "rs2", "rs3", "rs4", "diabetes"])
    chosen = selection.fit_selection(df, ["a", "b", "c", "noise", "steady"], snp_target_corr_threshold=0.2)
    # b and c repeat a earlier column even though b itself goes; an undefined correlation stays for phenotypes.
    assert chosen.phenotypes == ["a", "steady"]
    assert set(chosen.dropped_phenotypes) == {"b", "c", "noise"}
    assert chosen.snps == ["rs1"]  # rs2 repeats rs1, rs3 is constant, rs4 is unrelated
    assert chosen.dropped_snps["rs2"] == "redundant"
    back = selection.Selection.from_frame(chosen.to_frame(spark))
    assert (back.features, back.thresholds["snp_correlation_threshold"]) == (["a", "steady", "rs1"], 0.98)
    with pytest.raises(ValueError, match="unknown thresholds"):
        selection.fit_selection(df, ["a"], typo=1.0)
    with pytest.raises(ValueError, match="missing columns"):
        selection.fit_selection(df, ["a"], target="gone")


def test_histograms_count_like_numpy(spark):
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.normal(size=500), np.round(rng.normal(size=200), 1)])
    df = spark.createDataFrame([(float(v), int(i % 2)) for i, v in enumerate(values)] + [(None, 0)], "v double, diabetes int")
    for got, part in (
        (distribution.histogram(df, "v"), values),
        (distribution.class_histogram(df, "v").where("class = 1"), values[1::2]),
    ):
        counts, edges = np.histogram(part, 30)
        rows = got.orderBy("bin").collect()
        assert [r["n"] for r in rows] == list(counts)
        assert [r["bin_start"] for r in rows] + [rows[-1]["bin_end"]] == pytest.approx(list(edges))
    flat = spark.createDataFrame([(3.0,)] * 5, "rs1 double")
    assert [r["n"] for r in distribution.histogram(flat, "rs1").orderBy("bin").collect()] == list(np.histogram([3.0] * 5, 3)[0])


def test_box_and_scatter(spark):
    df = spark.createDataFrame([(float(v), 0) for v in [1, 2, 3, 4, 5, 50]] + [(None, 1)], "v double, diabetes int")
    box = distribution.box_statistics(df, "v").first()
    assert (box["q1"], box["median"], box["q3"]) == (2.25, 3.5, 4.75)
    assert (box["whisker_low"], box["whisker_high"], box["n_outliers"]) == (1.0, 5.0, 1)
    keyed = df.selectExpr("*", "cast(v as bigint) as patient_id")
    points = sorted((p["y"], p["x"]) for p in distribution.scatter_points(keyed, "v").collect())
    assert len(points) == 6 and all(abs(x) <= 0.05 for _, x in points)
    assert points == sorted((p["y"], p["x"]) for p in distribution.scatter_points(keyed.repartition(5), "v").collect())


def test_correlations_do_not_depend_on_the_columns_offered(spark):
    rows = [(5 + 1e-7 * (i % 2), 1.0 * (i // 2 % 2) if i < 100 else None) for i in range(100)]
    rows += [(1e3 * i, None) for i in range(100, 200)]
    rows = [(a, b, 0.1, *(float((i * (k + 3)) % 17) for k in range(40))) for i, (a, b) in enumerate(rows)]
    names = ["a", "b", "k", *(f"x{k}" for k in range(40))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(3)
    many = {(r["feature_a"], r["feature_b"]): r["r"] for r in correlation.correlation_pairs(df, names).collect()}
    x, y = np.array([r[0] for r in rows[:100]]), np.array([r[1] for r in rows[:100]])
    assert many["a", "b"] == pytest.approx(np.corrcoef(x - 5, y)[0, 1], abs=1e-6)
    assert many["a", "k"] is None and all(r is None or -1 <= r <= 1 for r in many.values())
    for pair in (("a", "b"), ("a", "k"), ("b", "x3"), ("x0", "x39")):
        alone = correlation.correlation_pairs(df, list(pair)).first()["r"]
        assert (alone is None) == (many[pair] is None)
        assert alone is None or alone == pytest.approx(many[pair], abs=1e-7)


def test_tails_of_large_tables():
    for dof in (1e5, 2e5, 3e5, 1e8, 1e10):
        assert 0.499 < chi2_tail(dof, dof) < 0.5
    assert chi2_tail(1.999e5, 1.999e5) == pytest.approx(chi2_tail(2.001e5, 2.001e5), abs=1e-6)
    assert chi2_tail(2.02e5, 1.9999e5) == pytest.approx(chi2_tail(2.0202e5, 2.0001e5), rel=2e-2)


def test_overview_counts_nan_like_missing_values(spark):
    from cohortkit.operators import profile

    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "v double, t string")
    whole = profile.overview(df, "x").first()["missing_values"]
    assert whole == {r["column"]: r["missing"] for r in profile.missing_values(df).collect()} == {"v": 2, "t": 1}


def test_names_with_quotes(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 1), (1.0, 1)], "`rs'1\\` double, diabetes int")
    assert snp.minor_allele_frequency(df, ["rs'1\\"]).first()["snp"] == "rs'1\\"


def test_time_keys(spark):
    df = spark.createDataFrame([("2024-1-5", 1.0), ("2025-07-01", 3.0), ("bad", 9.0), ("2025-07-01", 5.0)], "registry_date string, v double")
    assert [tuple(r) for r in temporal.cohort_size(df).collect()] == [(2024, 1), (2025, 2)]
    assert [r["value"] for r in temporal.feature_trend(df, "v", agg="median").collect()] == [1.0, 4.0]
    assert [str(r[0]) for r in temporal.cohort_size(df, "registry_date").collect()] == ["2024-01-05", "2025-07-01"]
    for bad in ({"mode": "month"}, {"agg": "mode"}):
        with pytest.raises(ValueError):
            temporal.feature_trend(df, "v", **bad)


def test_a_few_pairs_stay_out_of_python_and_agree_with_the_scan(spark):
    rows = [(1.0, 2.0, 5.0, float("nan")), (2.0, 1.0, 5.0, 1.0), (None, 7.0, 5.0, 2.0), (4.0, 9.0, 5.0, 3.5), (5.5, None, 5.0, -4.0)]
    df = spark.createDataFrame(rows * 3, "a double, b double, k double, n double")
    pairs = correlation.cross_correlations(df, ["a", "k"], ["b", "n", "a", "k"])
    assert "InPandas" not in pairs._jdf.queryExecution().toString()
    few = {(r["feature_a"], r["feature_b"]): r["r"] for r in pairs.collect()}
    scan = {(r["feature_a"], r["feature_b"]): r["r"] for r in correlation._scans(df, ["a", "k"], ["b", "n", "a", "k"]).collect()}
    assert few == {at: r if r is None else pytest.approx(r, abs=1e-12) for at, r in scan.items()}
    assert few["a", "k"] is None and few["a", "a"] == pytest.approx(1)
