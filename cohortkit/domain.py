"""Names and limits of the clinical cohort data model.

Everything here is a default; operators take column names as arguments.
"""

from __future__ import annotations

KEY = "patient_id"
TARGET = "diabetes"
SNP_PREFIX = "rs"
REGISTRY_DATE = "registry_date"

# Raw phenotype columns and their Spark types.
RAW_PHENOTYPE_TYPES = {
    "patient_id": "bigint",
    "year": "double",
    "gender": "string",
    "age": "double",
    "location": "string",
    "race:africanamerican": "int",
    "race:asian": "int",
    "race:caucasian": "int",
    "race:hispanic": "int",
    "race:other": "int",
    "hypertension": "double",
    "heart_disease": "double",
    "smoking_history": "string",
    "bmi": "double",
    "hba1c_level": "double",
    "blood_glucose_level": "double",
    "diabetes": "int",
}

# The SNP columns of a raw genotype file.
SNPS = [
    "rs61652270", "rs60004782", "rs9554188", "rs9581927", "rs9581929", "rs7985481",
    "rs9581931", "rs4424773", "rs9554193", "rs7995917", "rs7993114", "rs11618581",
    "rs9554197", "rs11618036", "rs11618832", "rs11616678", "rs11618052", "rs9579127",
    "rs7999100", "rs8000004", "rs9579128", "rs2297316", "rs9581943",
]

# Columns that phenotype cleaning cannot do without.
REQUIRED_PHENOTYPE = [
    "patient_id", "year", "gender", "age", "hypertension", "heart_disease",
    "smoking_history", "bmi", "hba1c_level", "blood_glucose_level", "diabetes",
]

# Text columns filled with "unknown", and columns filled with their median.
TEXT_FILL = {"gender": "unknown", "smoking_history": "unknown"}
MEDIAN_FILL = [
    "year", "age", "bmi", "hypertension", "heart_disease", "hba1c_level", "blood_glucose_level",
]

# Smoking answers, in one-hot order.
SMOKING_ANSWERS = ["never", "former", "current", "not current", "No Info", "ever"]

# Types after cleaning.
INTEGER_COLUMNS = [
    "patient_id", "year", "age", "hypertension", "heart_disease", "blood_glucose_level", "diabetes",
]
FLOAT_COLUMNS = ["bmi", "hba1c_level"]

# Inclusive clinical ranges.
CLINICAL_RANGES = {
    "age": (0, 120),
    "bmi": (10, 82),
    "hba1c_level": (3, 20),
    "blood_glucose_level": (40, 600),
}

# Genotype quality limits.
DOSAGES = [0, 1, 2]
MAX_MISSING_RATE = 0.10
MIN_ALLELE_FREQUENCY = 0.01

# One-hot groups in the order of their labels (codes start at 1).
RACE_LABELS = {
    "raceafricanamerican": "African American",
    "raceasian": "Asian",
    "racecaucasian": "Caucasian",
    "racehispanic": "Hispanic",
    "raceother": "Other",
}
SMOKING_LABELS = {
    "smoking_no_info": "No Info",
    "smoking_current": "Current",
    "smoking_ever": "Ever",
    "smoking_former": "Former",
    "smoking_never": "Never",
    "smoking_not_current": "Not current",
}

# Binary columns of the feature screen.
BINARY_COLUMNS = ["gender", "hypertension", "heart_disease"]

# Left-closed bin edges; the last bin is open to the right.
BMI_EDGES = [0.0, 18.5, 25.0, 30.0]
AGE_EDGES = [0.0, 30.0, 45.0, 60.0, 75.0]

# Ordinal smoking scale, first match wins; no match is -1.
SMOKING_SCALE = {
    "smoking_no_info": -1,
    "smoking_never": 0,
    "smoking_former": 1,
    "smoking_ever": 1,
    "smoking_not_current": 2,
    "smoking_current": 3,
}

# Phenotype columns offered to feature selection, in order.
PHENOTYPE_FEATURES = [
    "gender", "age", "hypertension", "heart_disease", "bmi", "hba1c_level",
    "blood_glucose_level", "smoking_ordinal", "bmi_group", "age_group", "metabolic_risk_score",
]

# Selection thresholds.
SELECTION_THRESHOLDS = {
    "phenotype_correlation_threshold": 0.80,
    "phenotype_target_corr_threshold": 0.20,
    "snp_variance_threshold": 0.01,
    "snp_target_corr_threshold": 0.05,
    "snp_correlation_threshold": 0.98,
}

# Extensions accepted per kind of upload.
ACCEPTED_EXTENSIONS = {
    "phenotypic": [".csv", ".xlsx", ".json"],
    "genotypic": [".csv", ".xlsx", ".json", ".vcf", ".bed", ".bim", ".fam"],
    "image": [".jpg", ".jpeg", ".png", ".tif", ".tiff", ".dcm"],
}

# Columns that analyses never offer as a feature.
NOT_A_FEATURE = ["patient_id", "registry_date", "year", "location"]

# Fixed value: level of significance.
ALPHA = 0.05
DECISION_THRESHOLD = 0.5


def snp_columns(columns: list[str], prefix: str = SNP_PREFIX) -> list[str]:
    """The SNP columns of a table, in table order."""
    return [c for c in columns if c.startswith(prefix)]
