import pytest
from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.operators import cleaning, features, integrate, quality
from cohortkit.operators import columns as cols
from tests.people import EXPECTED, five_patients, geno_rows, pheno_rows


def test_five_patients_get_the_expected_features(spark):
    pheno, geno = five_patients(spark)
    built = features.engineer_features(cleaning.clean_phenotypes(pheno))
    got = {
        r["patient_id"]: (r["bmi_group"], r["age_group"], r["metabolic_risk_score"], r["smoking_ordinal"])
        for r in built.collect()
    }
    assert got == EXPECTED
    assert integrate.join_cohort(built, geno).count() == 4
    assert [r["patient_id"] for r in integrate.unmatched(built, geno).collect()] == [15]


def test_bins_are_left_closed_and_null_below_zero(spark):
    df = spark.createDataFrame([(18.5, 30.0), (18.49, 29.9), (30.0, 75.0), (-1.0, -0.5), (None, None)], "bmi double, age double")
    got = [tuple(r) for r in df.select(features.bmi_group(), features.age_group()).collect()]
    assert got == [(1, 1), (0, 0), (3, 4), (None, None), (None, None)]


def test_risk_counts_unknown_as_absent(spark):
    df = spark.createDataFrame([(31.0, None, 1, 6.5)], "bmi double, hypertension int, heart_disease int, hba1c_level double")
    assert df.select(features.metabolic_risk_score()).first()[0] == 3


def test_names_duplicates_fill_and_codes(spark):
    raw = pheno_rows(spark, [
        {"patient_id": 1, "gender": None, "age": None, "smoking_history": None},
        {"patient_id": 1, "gender": None, "age": None, "smoking_history": None},
        {"patient_id": 2, "gender": "Male", "age": 10.9, "smoking_history": "not current"},
        {"patient_id": 3, "gender": "Female", "age": 20.0, "smoking_history": "pipe"},
    ])
    rows = {r["patient_id"]: r for r in cleaning.clean_phenotypes(raw).collect()}
    assert len(rows) == 3
    assert [rows[i]["gender"] for i in (1, 2, 3)] == [2, 1, 0]  # Female, Male, unknown
    assert rows[1]["age"] == 15 and rows[2]["age"] == 10  # median of 10.9 and 20, truncated
    smoking = [c for c in rows[1].asDict() if c.startswith("smoking_")]
    assert len(smoking) == 6
    assert sum(rows[1][c] for c in smoking) == 0 and sum(rows[3][c] for c in smoking) == 0
    assert rows[2]["smoking_not_current"] == 1
    assert "raceasian" in rows[1].asDict()


def test_fitted_state_codes_one_new_row_like_the_cohort(spark):
    cohort = pheno_rows(spark, [{"patient_id": i, "gender": g} for i, g in enumerate(["Female", "Male", "Other"])])
    fit = cleaning.fit_phenotypes(cleaning.prepare_phenotypes(cohort))
    fit = cleaning.PhenotypeFit.from_json(fit.to_json())
    new = pheno_rows(spark, [{"patient_id": 9, "gender": "Other", "age": None}])
    row = cleaning.clean_phenotypes(new, fit).first()
    assert (row["gender"], row["age"]) == (2, 50)
    unseen = cleaning.encode_phenotypes(cleaning.prepare_phenotypes(pheno_rows(spark, [{"gender": "?"}])), fit)
    assert unseen.first()["gender"] is None


def test_label_codes_are_fitted_as_a_table(spark):
    cohort = pheno_rows(spark, [{"patient_id": i, "gender": g} for i, g in enumerate("dbca")])
    ready = cleaning.prepare_phenotypes(cohort)
    fit = cleaning.PhenotypeFit.from_json(cleaning.fit_phenotypes(ready).to_json())
    assert fit.gender_codes is None

    fit.codes(spark).createOrReplaceTempView("kept_codes")
    stored = cleaning.PhenotypeFit.from_json(fit.stored("kept_codes").to_json())
    new = pheno_rows(spark, [{"patient_id": i, "gender": g} for i, g in enumerate("cz")])
    for f in (fit, stored):
        rows = cleaning.encode_phenotypes(cleaning.prepare_phenotypes(new), f).collect()
        assert {r["patient_id"]: r["gender"] for r in rows} == {0: 2, 1: None}
    spark.catalog.dropTempView("kept_codes")


def test_out_of_range_and_missing_columns_raise(spark):
    with pytest.raises(ValueError, match="bmi"):
        cleaning.clean_phenotypes(pheno_rows(spark, [{"bmi": 9.0}]))
    with pytest.raises(ValueError, match="diabetes"):
        cleaning.clean_phenotypes(pheno_rows(spark, [{"diabetes": None}]))
    with pytest.raises(ValueError, match="missing columns"):
        cleaning.clean_phenotypes(pheno_rows(spark, [{}]).drop("bmi"))


def test_genotype_quality_filters_then_fills(spark):
    rows = {i: [i % 3, 0, None if i < 3 else 1, None if i < 2 else 2] for i in range(20)}
    geno = geno_rows(spark, rows, ["rs1", "rs2", "rs3", "rs4"])
    clean = cleaning.clean_genotypes(geno)
    assert clean.columns == ["patient_id", "rs1", "rs4"]  # rs2 is too rare, rs3 misses 15 %
    assert clean.where("patient_id = 0").first()["rs4"] == 2.0
    with pytest.raises(ValueError, match="rs1"):
        cleaning.clean_genotypes(geno_rows(spark, {1: [3]}, ["rs1"]))
    kept = cleaning.clean_genotypes(geno_rows(spark, {7: [None]}, ["rs1"]), cleaning.GenotypeFit({"rs1": 0.5}))
    assert kept.first()["rs1"] == 0.5


def test_text_dosages_become_null(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("NaN",)], "rs1 string")
    assert [r[0] for r in cols.coerce_numbers(df, ["rs1"]).collect()] == [1.0, None, None, None]


def test_one_hot_last_match_wins(spark):
    df = spark.createDataFrame([(1, 1), (0, 0), (1, 0)], "a int, b int")
    assert [r["code"] for r in cleaning.decode_one_hot(df, ["a", "gone", "b"], "code").collect()] == [3, None, 1]


def test_align_and_select(spark):
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    assert cols.align_to(df, ["a", "c", "b"]).first().asDict() == {"a": 2, "c": 0, "b": 1}
    with pytest.raises(ValueError, match="unexpected"):
        cols.align_to(df, ["a"])
    with pytest.raises(ValueError, match="missing"):
        cols.select_features(df, ["z"])
    assert cols.key_first(df, "a").columns == ["a", "b"]


def test_outliers_need_a_value(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]] + [(None,)], "v double")
    assert [r["v"] for r in quality.flag_outliers(df, "v").where("is_outlier").collect()] == [100.0]


def test_duplicate_keys_stop_integration(spark):
    pheno, geno = five_patients(spark)
    with pytest.raises(ValueError, match="duplicate"):
        integrate.integrate(pheno.unionByName(pheno), geno, None)


@pytest.mark.parametrize("text, ok", [
    ("2025-12-25", True), ("2025-1-5", True), (None, True), ("25-12-2025", False), ("2025-02-30", False),
    ("", False), ("2025-12-25x", False), ("20250-1-1", False),
])
def test_registry_dates(spark, text, ok):
    df = spark.createDataFrame([(text,)], "d string")
    assert (df.select(quality.date_error(F.col("d"))).first()[0] is None) == ok


def test_required_raw_columns_are_known():
    assert len(domain.RAW_PHENOTYPE_TYPES) == 17 and len(domain.SNPS) == 23
