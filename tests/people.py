"""Small hand-made patients."""

from __future__ import annotations

from cohortkit import domain

PHENO_COLUMNS = list(domain.RAW_PHENOTYPE_TYPES)

# key: gender, age, smoking, bmi, hba1c, glucose, hypertension, dosage, genotype key
FIVE = {
    11: ("Female", 29.0, "ever", 17.9, 5.1, 95.0, 0.0, 0, 11),
    12: ("Male", 30.0, "not current", 26.4, 6.6, 150.0, 1.0, 1, 12),
    13: ("Female", 62.0, "current", 33.0, 7.2, 210.0, 1.0, 2, 13),
    14: ("Male", 75.0, "No Info", 24.9, 5.9, 130.0, 0.0, 1, 14),
    15: ("Female", 59.0, "never", 30.0, 6.4, 160.0, 0.0, 2, 77),
}
# By the rules of ``operators/features``: bmi group, age group, risk score, smoking code.
EXPECTED = {11: (0, 0, 0, 1), 12: (2, 1, 2, 2), 13: (3, 3, 3, 3), 14: (1, 4, 0, -1), 15: (3, 2, 1, 0)}


def _schema():
    return ", ".join(f"`{c}` {t}" for c, t in domain.RAW_PHENOTYPE_TYPES.items())


def pheno_rows(spark, rows):
    """Phenotype table from dicts; what a row leaves out gets a plain default."""
    base = {
        "patient_id": 1, "year": 2019.0, "gender": "Male", "age": 50.0, "location": "X", "race:africanamerican": 0,
        "race:asian": 1, "race:caucasian": 0, "race:hispanic": 0, "race:other": 0, "hypertension": 0.0,
        "heart_disease": 0.0, "smoking_history": "never", "bmi": 25.0, "hba1c_level": 6.0,
        "blood_glucose_level": 120.0, "diabetes": 0,
    }
    return spark.createDataFrame([tuple({**base, **r}[c] for c in PHENO_COLUMNS) for r in rows], _schema())


def geno_rows(spark, dosages, snps=None):
    """Genotype table: key to one dosage for all SNPs, or to a list of dosages."""
    snps = snps or domain.SNPS
    rows = [(k, *([d] * len(snps) if not isinstance(d, list) else d)) for k, d in dosages.items()]
    return spark.createDataFrame(rows, "patient_id bigint, " + ", ".join(f"{s} int" for s in snps))


def five_patients(spark):
    pheno = [
        {"patient_id": k, "gender": g, "age": a, "smoking_history": s, "bmi": b, "hba1c_level": h,
         "blood_glucose_level": gl, "hypertension": ht, "diabetes": 1}
        for k, (g, a, s, b, h, gl, ht, _, _) in FIVE.items()
    ]
    return pheno_rows(spark, pheno), geno_rows(spark, {v[8]: v[7] for v in FIVE.values()})
