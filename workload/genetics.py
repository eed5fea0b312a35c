"""Genotypes in long form, top SNPs by outcome, and the joint screen of the joined cohort."""

from __future__ import annotations

from cohortkit.operators import cleaning, genotypes, hypothesis, integrate, snp
from workload.registry import chi2_tail_sql, query, rounded, t_tail_sql
from workload.statistics import _ADJUST, _RACE_CODE, _SCAN, _SMOKING_CODE, _WELCH_STAT, _chi_sql, _welch_sql
from workload.tables import GENO_NAMES, table, view

# A SNP per part, far more than a wide plan holds; lines are its patients.
_LONG = (
    "SELECT l_orderkey * 10 + l_linenumber AS patient_id, concat('rs', CAST(l_partkey AS VARCHAR(20))) AS snp, "
    "CASE WHEN (l_orderkey + l_partkey) % 17 = 0 THEN NULL WHEN l_partkey % 50 = 7 THEN CAST(0 AS DOUBLE) "
    "ELSE CAST((l_orderkey + l_linenumber) % 3 AS DOUBLE) END AS dosage FROM lineitem"
)
_REPORT = (
    "SELECT snp, avg(CASE WHEN dosage IS NULL THEN CAST(1 AS DOUBLE) ELSE 0 END) AS missing_rate, avg(dosage) AS mean_dosage "
    "FROM long_geno GROUP BY snp"
)


def _long(spark, folder):
    return spark.sql(_LONG.replace("FROM lineitem", "FROM {lines}"), lines=table(spark, folder, "lineitem"))


@query(
    "long_snp_quality",
    f"WITH long_geno AS ({_LONG}) SELECT snp, round(missing_rate, 6) AS missing_rate, round(mean_dosage / 2, 6) AS allele_frequency, "
    f"coalesce(missing_rate <= 0.1 AND mean_dosage / 2 >= 0.01, false) AS kept FROM ({_REPORT})",
)
def long_snp_quality(spark, folder):
    report = genotypes.long_snp_quality(_long(spark, folder))
    return rounded(report.select("snp", "missing_rate", "allele_frequency", "kept"), 6, "missing_rate", "allele_frequency")


@query(
    "long_clean_genotypes",
    f"WITH long_geno AS ({_LONG}), kept AS (SELECT * FROM ({_REPORT}) WHERE missing_rate <= 0.1 AND mean_dosage / 2 >= 0.01) "
    "SELECT patient_id, g.snp, round(coalesce(g.dosage, kept.mean_dosage), 6) AS dosage FROM long_geno g JOIN kept ON g.snp = kept.snp",
)
def long_clean_genotypes(spark, folder):
    return rounded(genotypes.clean_long_genotypes(_long(spark, folder)), 6, "dosage")


@query(
    "long_form_of_wide_genotypes",
    "SELECT patient_id, " + ", ".join(f"round({s}, 6) AS {s}" for s in ("rs1", "rs2", "rs5", "rs6")) + " FROM kept_geno",
)
def long_form_of_wide_genotypes(spark, folder):
    """The long cleaner on the wide table's rows gives what the wide cleaner gives."""
    long = snp.to_long(view(spark, folder, "geno"), GENO_NAMES, ["patient_id"])
    kept = ["rs1", "rs2", "rs5", "rs6"]
    return rounded(genotypes.wide_genotypes(genotypes.clean_long_genotypes(long), kept), 6, *kept)


@query(
    "top_snp_outcome_shares",
    f"{_SCAN}, top AS (SELECT snp FROM adj WHERE q <= 0.05 ORDER BY q, snp LIMIT 10), "
    "valid AS (SELECT * FROM long_snps WHERE dosage IN (0, 1, 2) AND target IS NOT NULL AND snp IN (SELECT snp FROM top)), "
    "grid AS (SELECT snp, d, t FROM (SELECT DISTINCT snp FROM valid), (VALUES (0), (1), (2)) a(d), (VALUES (0), (1)) b(t)) "
    "SELECT grid.snp, d AS dosage, t AS target, round((SELECT count(*) FROM valid v WHERE v.snp = grid.snp AND dosage = d AND target = t) "
    "/ CAST((SELECT count(*) FROM valid v WHERE v.snp = grid.snp) AS DOUBLE), 6) AS share FROM grid",
)
def top_snp_outcome_shares(spark, folder):
    cube = snp.snp_cube(view(spark, folder, "snps"))
    return rounded(snp.genotype_outcome_shares(cube, snp.association(cube), 10), 6, "share")


_COUNTED = {c: c for c in ("rs1", "rs2", "rs5", "rs6", "gender", "hypertension", "heart_disease")}
_COUNTED |= {"race": _RACE_CODE, "smoking": _SMOKING_CODE}
_MEASURED = ["year", "age", "blood_glucose_level", "bmi", "hba1c_level"]


@query(
    "joint_feature_screen",
    _chi_sql(" UNION ALL ".join(
        f"SELECT '{name}' AS feature, CAST({code} AS DOUBLE) AS level, diabetes AS y FROM cohort" for name, code in _COUNTED.items()))
    + f", m AS ({_welch_sql('cohort', _MEASURED, 'diabetes')}), t AS ({_WELCH_STAT} FROM m WHERE n_0 >= 2 AND n_1 >= 2), "
    f"tests AS (SELECT feature, 'chi2' AS test_group, statistic, {chi2_tail_sql('statistic', 'dof')} AS p FROM stat UNION ALL "
    f"SELECT feature, 'ttest', statistic, {t_tail_sql('statistic', 'dof')} FROM t), {_ADJUST} "
    "SELECT feature, test_group, round(statistic, 4) AS statistic, round(p, 5) AS p_value, round(q, 5) AS p_fdr, "
    "coalesce(q <= 0.05, false) AS significant FROM adj",
)
def joint_feature_screen(spark, folder):
    """SNPs, gender, clinical columns, race and smoking of the joined cohort, with one joint adjustment."""
    clean = cleaning.clean_phenotypes(view(spark, folder, "pheno"), check=False)
    cohort = integrate.join_cohort(clean, cleaning.clean_genotypes(view(spark, folder, "geno")))
    screen = hypothesis.feature_screen(cohort)
    return rounded(rounded(screen.drop("dof"), 5, "p_value", "p_fdr"), 4, "statistic")
