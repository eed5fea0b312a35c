"""Cleaning, encoding, engineered features and the cohort join."""

from __future__ import annotations


from cohortkit import domain
from cohortkit.operators import cleaning, features, integrate
from cohortkit.operators import columns as cols
from cohortkit.plans.featurize import build_features
from workload.registry import integers, query, rounded
from workload.tables import _MEDIANS, ENGINEERED, RECENT, table, view

CLEAN_COLUMNS = [
    "patient_id", "year", "age", "hypertension", "heart_disease", "blood_glucose_level", "bmi", "hba1c_level",
    "gender", "raceasian", "smoking_never", "smoking_former", "smoking_current", "smoking_not_current",
    "smoking_no_info", "smoking_ever", "diabetes",
]
CLEAN_SELECT = ", ".join(
    f"round(CAST({c} AS DOUBLE), 5) AS {c}" if c in ("bmi", "hba1c_level") else c for c in CLEAN_COLUMNS
)
ENGINEERED_NAMES = ["bmi_group", "age_group", "metabolic_risk_score", "smoking_ordinal"]


def _named(spark, folder):
    return cols.normalise_names(view(spark, folder, "pheno"))


@query(
    "distinct_rows",
    "SELECT DISTINCT l_linenumber, l_quantity, l_discount, l_returnflag FROM lineitem",
)
def distinct_rows(spark, folder):
    line = table(spark, folder, "lineitem").select("l_linenumber", "l_quantity", "l_discount", "l_returnflag")
    return cleaning.drop_duplicate_rows(line)


@query(
    "constant_fill",
    "SELECT patient_id, coalesce(gender, 'unknown') AS gender, coalesce(smoking_history, 'unknown') AS smoking_history "
    "FROM pheno",
)
def constant_fill(spark, folder):
    return cleaning.fill_constant(_named(spark, folder), domain.TEXT_FILL).select(
        "patient_id", "gender", "smoking_history"
    )


@query(
    "median_fill",
    "SELECT p.patient_id, " + ", ".join(f"round(coalesce(p.{c}, m.{c}), 6) AS {c}" for c in _MEDIANS)
    + " FROM pheno p CROSS JOIN (SELECT " + ", ".join(f"median({c}) AS {c}" for c in _MEDIANS) + " FROM pheno) m",
)
def median_fill(spark, folder):
    filled = cleaning.fill_median(_named(spark, folder), domain.MEDIAN_FILL)
    return rounded(filled.select("patient_id", *domain.MEDIAN_FILL), 6, *domain.MEDIAN_FILL)


@query(
    "mean_fill",
    "SELECT s.patient_id, round(coalesce(s.rs1, m.rs1), 6) AS rs1, round(coalesce(s.rs4, m.rs4), 6) AS rs4 "
    "FROM snps s CROSS JOIN (SELECT avg(rs1) AS rs1, avg(rs4) AS rs4 FROM snps) m",
)
def mean_fill(spark, folder):
    filled = cleaning.fill_mean(view(spark, folder, "snps"), ["rs1", "rs4"])
    return rounded(filled.select("patient_id", "rs1", "rs4"), 6, "rs1", "rs4")


@query(
    "label_encoding",
    "SELECT o.o_orderkey, CAST(c.code AS INTEGER) AS o_orderpriority FROM orders o JOIN (SELECT p, "
    "row_number() OVER (ORDER BY p) - 1 AS code FROM (SELECT DISTINCT o_orderpriority AS p FROM orders)) c "
    "ON o.o_orderpriority = c.p",
)
def label_encoding(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return cleaning.label_encode(orders, "o_orderpriority")


@query(
    "long_label_codes",
    "SELECT c_name AS value, CAST(row_number() OVER (ORDER BY c_name) - 1 AS INTEGER) AS code "
    "FROM (SELECT DISTINCT c_name FROM customer)",
)
def long_label_codes(spark, folder):
    return cleaning.label_codes(table(spark, folder, "customer"), "c_name")


_ANSWERS = ", ".join(f"'{a}'" for a in domain.SMOKING_ANSWERS)


@query(
    "canonical_categories",
    f"SELECT patient_id, CASE WHEN smoking_history IN ({_ANSWERS}) THEN smoking_history END AS smoking_history FROM pheno",
)
def canonical_categories(spark, folder):
    return cleaning.restrict_categories(
        _named(spark, folder).select("patient_id", "smoking_history"), "smoking_history", domain.SMOKING_ANSWERS
    )


@query(
    "smoking_one_hot",
    "SELECT patient_id, " + ", ".join(
        f"CASE WHEN smoking_history = '{a}' THEN 1 ELSE 0 END AS smoking_{a.lower().replace(' ', '_')}"
        for a in domain.SMOKING_ANSWERS
    ) + " FROM pheno",
)
def smoking_one_hot(spark, folder):
    return cleaning.one_hot(
        _named(spark, folder).select("patient_id", "smoking_history"), "smoking_history", domain.SMOKING_ANSWERS, "smoking"
    )


_RACES = list(domain.RACE_LABELS)


@query(
    "race_codes",
    "SELECT patient_id, CASE " + " ".join(f"WHEN {c} = 1 THEN {i + 1}" for i, c in reversed(list(enumerate(_RACES))))
    + " END AS race FROM pheno",
)
def race_codes(spark, folder):
    return cleaning.decode_one_hot(_named(spark, folder), _RACES, "race").select("patient_id", "race")


@query(
    "race_codes_from_zero",
    "SELECT patient_id, CASE " + " ".join(f"WHEN {c} = 1 THEN {i}" for i, c in reversed(list(enumerate(_RACES))))
    + " END AS race FROM pheno",
)
def race_codes_from_zero(spark, folder):
    return cleaning.decode_one_hot(_named(spark, folder), _RACES, "race", 0).select("patient_id", "race")


@query("clean_phenotypes", f"SELECT {CLEAN_SELECT} FROM clean")
def clean_phenotypes(spark, folder):
    clean = cleaning.clean_phenotypes(view(spark, folder, "pheno"), check=False)
    return rounded(clean.select(*CLEAN_COLUMNS), 5, "bmi", "hba1c_level")


@query("clean_phenotypes_fitted", f"SELECT {CLEAN_SELECT} FROM clean")
def clean_phenotypes_fitted(spark, folder):
    raw = view(spark, folder, "pheno")
    clean = cleaning.clean_phenotypes(raw, cleaning.fit_phenotypes(cleaning.prepare_phenotypes(raw)))
    return rounded(clean.select(*CLEAN_COLUMNS), 5, "bmi", "hba1c_level")


@query(
    "clean_genotypes",
    "SELECT patient_id, " + ", ".join(f"round({s}, 6) AS {s}" for s in ("rs1", "rs2", "rs5", "rs6")) + " FROM kept_geno",
)
def clean_genotypes(spark, folder):
    clean = cleaning.clean_genotypes(view(spark, folder, "geno"))
    return rounded(clean, 6, *[c for c in clean.columns if c != "patient_id"])


def _engineered_sql(names):
    return f"SELECT {', '.join(['patient_id', *names])} FROM (SELECT *, {ENGINEERED} FROM clean)"


def _clean(spark, folder):
    return cleaning.clean_phenotypes(view(spark, folder, "pheno"), check=False)


@query("bmi_groups", _engineered_sql(["bmi_group"]))
def bmi_groups(spark, folder):
    return _clean(spark, folder).select("patient_id", features.bmi_group().alias("bmi_group"))


@query("age_groups", _engineered_sql(["age_group"]))
def age_groups(spark, folder):
    return _clean(spark, folder).select("patient_id", features.age_group().alias("age_group"))


@query("metabolic_risk", _engineered_sql(["metabolic_risk_score"]))
def metabolic_risk(spark, folder):
    return _clean(spark, folder).select("patient_id", features.metabolic_risk_score().alias("metabolic_risk_score"))


@query("smoking_scale", _engineered_sql(["smoking_ordinal"]))
def smoking_scale(spark, folder):
    return _clean(spark, folder).select("patient_id", features.smoking_ordinal().alias("smoking_ordinal"))


@query("engineered_features", _engineered_sql(ENGINEERED_NAMES))
def engineered_features(spark, folder):
    return features.engineer_features(_clean(spark, folder)).select("patient_id", *ENGINEERED_NAMES)


def _sides(spark, folder, where=None):
    pheno = view(spark, folder, "pheno", where).select("patient_id", "gender", "bmi", "diabetes")
    geno = integers(view(spark, folder, "geno").select("patient_id", "rs1", "rs2"), "rs1", "rs2")
    return pheno, geno


_JOIN_SQL = (
    "SELECT p.patient_id, p.gender, p.bmi, p.diabetes, CAST(g.rs1 AS INTEGER) AS rs1, CAST(g.rs2 AS INTEGER) AS rs2 "
    "FROM pheno p JOIN geno g ON p.patient_id = g.patient_id"
)


@query("cohort_join", _JOIN_SQL)
def cohort_join(spark, folder):
    return integrate.join_cohort(*_sides(spark, folder))


@query("new_patient_join", f"{_JOIN_SQL} WHERE p.patient_id IN (SELECT o_orderkey FROM orders WHERE {RECENT})")
def new_patient_join(spark, folder):
    return integrate.join_new_patients(*_sides(spark, folder, RECENT))


@query("unmatched_patients", "SELECT patient_id, gender FROM pheno WHERE patient_id NOT IN (SELECT patient_id FROM geno)")
def unmatched_patients(spark, folder):
    return integrate.unmatched(*_sides(spark, folder)).select("patient_id", "gender")


@query("integrated_cohort", _JOIN_SQL.replace("SELECT p.patient_id", "SELECT DATE '2025-12-25' AS registry_date, p.patient_id"))
def integrated_cohort(spark, folder):
    return integrate.integrate(*_sides(spark, folder), "2025-12-25")


@query(
    "built_features",
    f"SELECT patient_id, gender, age, {', '.join(ENGINEERED_NAMES)}, round(rs1, 6) AS rs1, diabetes FROM built",
)
def built_features(spark, folder):
    clean = _clean(spark, folder)
    geno = cleaning.clean_genotypes(view(spark, folder, "geno"))
    built = build_features(integrate.join_cohort(clean, geno))
    return rounded(built.select("patient_id", "gender", "age", *ENGINEERED_NAMES, "rs1", "diabetes"), 6, "rs1")
