"""Cohort-shaped views of the given tables.

Each view is a list of column expressions that Spark and DuckDB read alike, so
the queries and their SQL counterparts start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TRUTH = "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END"

PHENO = {
    "patient_id": "o_orderkey",
    "year": "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS DOUBLE) END",
    "gender": "CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_custkey % 31 = 1 THEN 'Other' "
    "WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END",
    "age": "CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST((o_custkey * 7 + o_orderkey * 3) % 96 AS DOUBLE) END",
    "location": "o_orderpriority",
    "race:africanamerican": "CASE WHEN o_custkey % 5 = 0 THEN 1 ELSE 0 END",
    "race:asian": "CASE WHEN o_custkey % 5 = 1 THEN 1 ELSE 0 END",
    "race:caucasian": "CASE WHEN o_custkey % 5 = 2 THEN 1 ELSE 0 END",
    "race:hispanic": "CASE WHEN o_custkey % 5 = 3 THEN 1 ELSE 0 END",
    "race:other": "CASE WHEN o_custkey % 5 >= 3 AND o_orderkey % 4 = 0 THEN 1 ELSE 0 END",
    "hypertension": "CASE WHEN o_orderkey % 61 = 0 THEN NULL WHEN (o_custkey + o_orderkey) % 4 = 0 "
    "THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "heart_disease": "CASE WHEN o_orderkey % 67 = 0 THEN NULL WHEN o_custkey % 9 = 0 "
    "THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "smoking_history": "CASE o_orderkey % 8 WHEN 0 THEN 'never' WHEN 1 THEN 'former' WHEN 2 THEN 'current' "
    "WHEN 3 THEN 'not current' WHEN 4 THEN 'No Info' WHEN 5 THEN 'ever' WHEN 6 THEN NULL ELSE 'sometimes' END",
    "bmi": "CASE WHEN o_orderkey % 43 = 0 THEN NULL "
    "ELSE CAST(120 + CAST(floor(o_totalprice) AS BIGINT) % 600 AS DOUBLE) / 10 END",
    "hba1c_level": "CASE WHEN o_orderkey % 47 = 0 THEN NULL ELSE "
    f"CAST(35 + o_orderkey % 60 + 15 * {TRUTH} AS DOUBLE) / 10 END",
    "blood_glucose_level": "CASE WHEN o_orderkey % 59 = 0 THEN NULL ELSE "
    f"CAST(70 + o_custkey % 200 + 60 * {TRUTH} AS DOUBLE) END",
    "diabetes": TRUTH,
}

SNPS = {
    "patient_id": "o_orderkey",
    "diabetes": f"CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE {TRUTH} END",
    "rs1": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST((o_orderkey * 7 + o_custkey) % 3 AS DOUBLE) END",
    "rs2": "CAST(CASE WHEN o_totalprice < 150000 THEN 0 WHEN o_totalprice < 350000 THEN 1 ELSE 2 END AS DOUBLE)",
    "rs3": "CAST(CASE WHEN o_orderstatus = 'F' THEN CASE (o_custkey * 3 + o_orderkey) % 5 WHEN 0 THEN 0 "
    "WHEN 1 THEN 1 ELSE 2 END ELSE CASE WHEN (o_custkey * 3 + o_orderkey) % 5 < 2 THEN 0 "
    "WHEN (o_custkey * 3 + o_orderkey) % 5 < 4 THEN 1 ELSE 2 END END AS DOUBLE)",
    "rs4": "CASE WHEN o_orderkey % 13 = 0 THEN CAST(7 AS DOUBLE) / 10 ELSE CAST(o_custkey % 3 AS DOUBLE) END",
    "rs5": "CAST(1 AS DOUBLE)",
    "rs6": f"CAST(CASE WHEN (o_custkey + {TRUTH}) % 7 < 3 THEN 1 ELSE 0 END AS DOUBLE)",
    "rs7": "CAST(CASE WHEN o_orderkey % 400 = 0 THEN 2 WHEN o_orderstatus = 'F' THEN "
    "CASE (o_custkey * 3 + o_orderkey) % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END ELSE "
    "CASE WHEN (o_custkey * 3 + o_orderkey) % 5 < 2 THEN 0 WHEN (o_custkey * 3 + o_orderkey) % 5 < 4 "
    "THEN 1 ELSE 2 END END AS DOUBLE)",
}
SNP_NAMES = [c for c in SNPS if c.startswith("rs")]

# Genotypes come from lineitem, so some patients of PHENO have none.
GENO = {
    "patient_id": "l_orderkey",
    "rs1": "CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE "
    "CAST(least(2, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)) AS BIGINT) END",
    "rs2": "max(l_linenumber) % 3",
    "rs3": "CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE min(l_linenumber) % 3 END",
    "rs4": "CASE WHEN l_orderkey % 500 = 0 THEN 1 ELSE 0 END",
    "rs5": "min(l_linenumber) % 3",
    "rs6": "CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE count(*) % 3 END",
}
GENO_NAMES = [c for c in GENO if c.startswith("rs")]

PREDS = {
    "patient_id": "o_orderkey",
    "y_true": TRUTH,
    "y_prob": f"CAST((o_orderkey * 37) % 700 + 300 * {TRUTH} AS DOUBLE) / 1000",
}

REQUESTS = {
    "patient_id": "o_orderkey",
    "is_single_patient": "o_orderkey % 3 > 0",
    "consent_to_store": "o_custkey % 2 = 0",
    "consent_raw": "o_custkey % 2 = 0",
    "consent_integrate": "o_custkey % 3 = 0",
    "consent_retrain": "o_custkey % 5 < 2",
    "has_pheno": "o_orderkey % 7 > 0",
    "has_geno": "o_orderkey % 10 > 0",
    "registry_date": "CASE o_orderkey % 7 WHEN 0 THEN '2025-12-25' WHEN 1 THEN '2025-1-5' WHEN 2 THEN '25-12-2025' "
    "WHEN 3 THEN '2025-02-30' WHEN 4 THEN '' WHEN 5 THEN NULL ELSE '2024-02-29' END",
    "data_type": "CASE o_custkey % 5 WHEN 0 THEN 'phenotypic' WHEN 1 THEN 'genotypic' WHEN 2 THEN 'image' "
    "WHEN 3 THEN 'audio' ELSE NULL END",
    "path": "concat('/uploads/p', CAST(o_orderkey AS VARCHAR(20)), CASE o_orderkey % 6 WHEN 0 THEN '.csv' "
    "WHEN 1 THEN '.CSV' WHEN 2 THEN '.vcf' WHEN 3 THEN '.png' WHEN 4 THEN '.tar.gz' ELSE '' END)",
    "source": "o_orderpriority",
    "consent_raw_storage": "o_custkey % 2 = 0",
}

# Uploads of the last half year, the "new" side of joins.
RECENT = "o_orderdate >= TIMESTAMP '2001-01-01 00:00:00'"

_FROM = {
    "pheno": (PHENO, "orders", ""),
    "snps": (SNPS, "orders", ""),
    "geno": (GENO, "lineitem", "GROUP BY l_orderkey"),
    "preds": (PREDS, "orders", ""),
    "requests": (REQUESTS, "orders", ""),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, folder: str, name: str, where: str | None = None) -> DataFrame:
    """A cohort-shaped view of a given table."""
    columns, base, group = _FROM[name]
    df = table(spark, folder, base)
    if where:
        df = df.where(where)
    if group:
        aggregates = [f"{e} AS `{c}`" for c, e in columns.items()]
        return spark.sql(f"SELECT {', '.join(aggregates)} FROM {{base}} {group}", base=df)
    return df.selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])


def view_sql(name: str) -> str:
    """The same view as DuckDB SQL, with normalised column names."""
    columns, base, group = _FROM[name]
    body = ", ".join(f"{e} AS {c.replace(':', '')}" for c, e in columns.items())
    return f"SELECT {body} FROM {base} {group}"


# Cleaned phenotypes and genotypes as SQL, built on the views.
_MEDIANS = ["year", "age", "bmi", "hypertension", "heart_disease", "hba1c_level", "blood_glucose_level"]
_SMOKING = {"never": "never", "former": "former", "current": "current", "not_current": "not current",
            "no_info": "No Info", "ever": "ever"}


def _clean_sql() -> str:
    filled = {c: f"coalesce(p.{c}, m.{c})" for c in _MEDIANS}
    integer = [c for c in _MEDIANS if c not in ("bmi", "hba1c_level")]
    parts = ["p.patient_id"]
    parts += [f"CAST(trunc({filled[c]}) AS INTEGER) AS {c}" for c in integer]
    parts += [f"CAST({filled[c]} AS FLOAT) AS {c}" for c in ("bmi", "hba1c_level")]
    parts += ["CAST(g.code AS INTEGER) AS gender", "p.location", "p.diabetes"]
    parts += [f"p.race{r}" for r in ("africanamerican", "asian", "caucasian", "hispanic", "other")]
    parts += [
        f"CASE WHEN p.smoking_history = '{v}' THEN 1 ELSE 0 END AS smoking_{c}" for c, v in _SMOKING.items()
    ]
    return (
        f"SELECT {', '.join(parts)} FROM pheno p "
        f"CROSS JOIN (SELECT {', '.join(f'median({c}) AS {c}' for c in _MEDIANS)} FROM pheno) m "
        "JOIN (SELECT g, row_number() OVER (ORDER BY g) - 1 AS code FROM "
        "(SELECT DISTINCT coalesce(gender, 'unknown') AS g FROM pheno)) g ON coalesce(p.gender, 'unknown') = g.g"
    )


ENGINEERED = (
    "CASE WHEN bmi >= 30 THEN 3 WHEN bmi >= 25 THEN 2 WHEN bmi >= 18.5 THEN 1 WHEN bmi >= 0 THEN 0 END AS bmi_group, "
    "CASE WHEN age >= 75 THEN 4 WHEN age >= 60 THEN 3 WHEN age >= 45 THEN 2 WHEN age >= 30 THEN 1 "
    "WHEN age >= 0 THEN 0 END AS age_group, "
    "CASE WHEN bmi >= 30 THEN 1 ELSE 0 END + CASE WHEN hypertension = 1 THEN 1 ELSE 0 END + "
    "CASE WHEN heart_disease = 1 THEN 1 ELSE 0 END + CASE WHEN hba1c_level >= CAST(6.5 AS DOUBLE) THEN 1 ELSE 0 END "
    "AS metabolic_risk_score, "
    "CASE WHEN smoking_no_info = 1 THEN -1 WHEN smoking_never = 1 THEN 0 WHEN smoking_former = 1 THEN 1 "
    "WHEN smoking_ever = 1 THEN 1 WHEN smoking_not_current = 1 THEN 2 WHEN smoking_current = 1 THEN 3 ELSE -1 END "
    "AS smoking_ordinal"
)

_DERIVED = {
    "clean": _clean_sql(),
    "kept_geno": "SELECT g.patient_id, "
    + ", ".join(
        f"CAST(coalesce(g.{s}, m.{s}) AS DOUBLE) AS {s}" for s in ("rs1", "rs2", "rs5", "rs6")
    )
    + " FROM geno g CROSS JOIN (SELECT avg(rs1) AS rs1, avg(rs2) AS rs2, avg(rs5) AS rs5, avg(rs6) AS rs6 FROM geno) m",
    "cohort": "SELECT c.*, k.rs1, k.rs2, k.rs5, k.rs6 FROM clean c JOIN kept_geno k ON c.patient_id = k.patient_id",
    "built": f"SELECT cohort.*, {ENGINEERED} FROM cohort",
    "long_snps": " UNION ALL ".join(
        f"SELECT '{s}' AS snp, {s} AS dosage, diabetes AS target FROM snps" for s in SNP_NAMES
    ),
}
_NEEDS = {
    "clean": ["pheno"],
    "kept_geno": ["geno"],
    "cohort": ["pheno", "clean", "geno", "kept_geno"],
    "built": ["pheno", "clean", "geno", "kept_geno", "cohort"],
    "long_snps": ["snps"],
}


def with_views(sql: str) -> str:
    """Put the views that ``sql`` mentions in front of it."""
    wanted: list[str] = []
    for name in [*_FROM, *_DERIVED]:
        if re.search(rf"\b{name}\b", sql):
            wanted += [n for n in [*_NEEDS.get(name, []), name] if n not in wanted]
    if not wanted:
        return sql
    bodies = [f"{n} AS ({view_sql(n) if n in _FROM else _DERIVED[n]})" for n in wanted]
    joint = ", " if sql.lstrip().startswith("WITH ") else " "
    rest = sql.lstrip()[5:] if joint == ", " else sql
    return "WITH " + ", ".join(bodies) + joint + rest
