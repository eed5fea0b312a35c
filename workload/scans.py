"""Sources, sinks, projections and row filters."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cohortkit.functions.columns import registry_timestamp
from cohortkit.operators import columns as cols
from cohortkit.operators import evaluation, quality
from cohortkit.operators.correlation import correlation_pairs, redundant_features
from cohortkit.operators.ordering import long_values
from cohortkit.operators.selection import Selection
from cohortkit.session import scratch_path
from cohortkit.sources import manifest, readers, writers
from workload.registry import query, rounded
from workload.tables import GENO_NAMES, RECENT, SNP_NAMES, table, view

PHENO_CHECK = ["patient_id", "gender", "age", "bmi", "smoking_history", "diabetes"]
PHENO_CHECK_SQL = f"SELECT {', '.join(PHENO_CHECK)} FROM pheno"


def _new_table(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


@query("csv_scan", PHENO_CHECK_SQL)
def csv_scan(spark, folder):
    path = scratch_path(spark, "csv")
    writers.write_csv(view(spark, folder, "pheno"), path)
    return cols.normalise_names(readers.read_phenotypes(spark, path)).select(*PHENO_CHECK)


@query("json_scan", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_scan(spark, folder):
    path = scratch_path(spark, "json")
    customer = table(spark, folder, "customer")
    # One JSON array of at most 500 customers per file.
    parts = customer.withColumn("part", F.floor(F.col("c_custkey") / 500)).groupBy("part").agg(
        F.concat(
            F.lit("["),
            F.array_join(F.collect_list(F.to_json(F.struct(*customer.columns))), ","),
            F.lit("]"),
        ).alias("value")
    )
    parts.write.partitionBy("part").text(path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return readers.read_json(spark, path, schema).select("c_custkey", "c_name", "c_acctbal")


@query("parquet_scan", "SELECT patient_id, rs1, rs2, rs3, diabetes FROM snps")
def parquet_scan(spark, folder):
    path = scratch_path(spark, "features")
    writers.write_parquet(view(spark, folder, "snps"), path)
    return readers.read_parquet(spark, path).select("patient_id", "rs1", "rs2", "rs3", "diabetes")


@query("checked_table_scan", "SELECT patient_id, year, diabetes FROM pheno")
def checked_table_scan(spark, folder):
    name = _new_table("pheno")
    writers.replace_table(cols.normalise_names(view(spark, folder, "pheno")), name, folder=scratch_path(spark, "t"))
    return readers.load_table(spark, name).select("patient_id", "year", "diabetes")


@query(
    "table_row_counts",
    "SELECT 'orders' AS name, true AS present, count(*) AS n FROM orders UNION ALL SELECT 'absent', false, 0",
)
def table_row_counts(spark, folder):
    name = _new_table("orders")
    writers.replace_table(table(spark, folder, "orders"), name, folder=scratch_path(spark, "t"))
    rows = [
        (label, readers.table_exists(spark, t), readers.count_rows(spark, t))
        for label, t in (("orders", name), ("absent", _new_table("absent")))
    ]
    return spark.createDataFrame(rows, "name string, present boolean, n bigint")


@query(
    "saved_predictions",
    "SELECT patient_id, y_true, CASE WHEN y_prob >= 0.5 THEN 1 ELSE 0 END AS y_pred, y_prob FROM preds",
)
def saved_predictions(spark, folder):
    path = scratch_path(spark, "predictions")
    writers.save_predictions(evaluation.classify(view(spark, folder, "preds")), path)
    return readers.load_predictions(spark, path)


@query(
    "selected_feature_log",
    "WITH r AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS qe FROM lineitem) "
    "SELECT 'phenotypic' AS family, f AS feature, CAST(row_number() OVER (ORDER BY f DESC) - 1 AS INTEGER) AS \"rank\" "
    "FROM (SELECT unnest(['l_tax', 'l_quantity']) AS f UNION ALL SELECT 'l_extendedprice' FROM r WHERE qe <= 0.8)",
)
def selected_feature_log(spark, folder):
    line = table(spark, folder, "lineitem")
    offered = ["l_tax", "l_quantity", "l_extendedprice"]
    gone = [r["feature"] for r in redundant_features(correlation_pairs(line, offered), 0.8).collect()]
    selection = Selection([c for c in offered if c not in gone], dict.fromkeys(gone, "redundant"))
    path = scratch_path(spark, "selection")
    writers.save_selection(selection, spark, path)
    log = spark.read.parquet(path)
    assert Selection.from_frame(log).phenotypes == selection.phenotypes
    return readers.load_selected_features(log)


@query("cohort_table_replace", "SELECT patient_id, year + 1 AS year, diabetes FROM pheno")
def cohort_table_replace(spark, folder):
    name, where = _new_table("clean"), scratch_path(spark, "t")
    writers.replace_table(view(spark, folder, "pheno").select("patient_id", "year", "diabetes"), name, folder=where)
    # The second write reads the table that it replaces.
    newer = spark.table(name).withColumn("year", F.col("year") + 1)
    writers.replace_table(newer, name, folder=where)
    return spark.table(name)


@query("patient_table_append", "SELECT patient_id, gender, diabetes FROM pheno")
def patient_table_append(spark, folder):
    name, where = _new_table("clean"), scratch_path(spark, "t")
    old = view(spark, folder, "pheno", f"NOT ({RECENT})").select("patient_id", "gender", "diabetes")
    new = view(spark, folder, "pheno", RECENT).select("diabetes", "patient_id", "gender")
    writers.append_table(old, name, folder=where)
    writers.append_table(new, name, folder=where)
    return spark.table(name)


@query(
    "merged_table_rebuild",
    "SELECT p.patient_id, p.diabetes, g.rs1, g.rs2 FROM pheno p JOIN geno g ON p.patient_id = g.patient_id",
)
def merged_table_rebuild(spark, folder):
    where = scratch_path(spark, "t")
    pheno, geno, merged = _new_table("pheno"), _new_table("geno"), _new_table("merged")
    writers.replace_table(view(spark, folder, "pheno").select("patient_id", "diabetes"), pheno, buckets=8, folder=where)
    writers.replace_table(view(spark, folder, "geno").select("patient_id", "rs1", "rs2"), geno, buckets=8, folder=where)
    return writers.rebuild_merged(pheno, geno, merged, spark, folder=where)


@query("feature_store_append", "SELECT patient_id, rs1, rs2, diabetes FROM snps")
def feature_store_append(spark, folder):
    name, where = _new_table("features"), scratch_path(spark, "t")
    for part in (f"NOT ({RECENT})", RECENT):
        rows = view(spark, folder, "snps", part).select("patient_id", "rs1", "rs2", "diabetes")
        writers.append_feature_store(rows, name, folder=where)
    return spark.table(name)


@query(
    "upload_audit",
    "SELECT CAST(patient_id AS VARCHAR) AS patient_id, string_split(path, '/')[-1] AS filename, data_type, source, "
    "registry_date, consent_raw_storage, true AS is_single_patient, true AS has_id_and_time FROM requests",
)
def upload_audit(spark, folder):
    name, where = _new_table("audit"), scratch_path(spark, "t")
    writers.append_audit(view(spark, folder, "requests"), name, folder=where)
    return spark.table(name).withColumn(
        "has_id_and_time", F.col("id").isNotNull() & F.col("uploaded_at").isNotNull()
    ).drop("id", "uploaded_at")


@query("merged_table_export", "SELECT patient_id, rs2, rs5 FROM geno")
def merged_table_export(spark, folder):
    name, where = _new_table("geno"), scratch_path(spark, "t")
    writers.replace_table(view(spark, folder, "geno").select("patient_id", "rs2", "rs5"), name, folder=where)
    path = scratch_path(spark, "export")
    writers.export_table(spark, name, path)
    return readers.read_csv(spark, path, {"patient_id": "bigint", "rs2": "int", "rs5": "int"})


@query(
    "normalised_names",
    "SELECT patient_id, raceasian, raceother, diabetes FROM pheno",
)
def normalised_names(spark, folder):
    named = cols.normalise_names(view(spark, folder, "pheno"))
    return named.select("patient_id", "raceasian", "raceother", "diabetes")


@query("dropped_columns", "SELECT patient_id, year, gender, diabetes FROM pheno")
def dropped_columns(spark, folder):
    some = view(spark, folder, "pheno").select(
        "patient_id", "year", "gender", "location", "`race:asian`", "`race:other`", "diabetes"
    )
    return cols.drop_columns(some, ["location", "not_there"], ["race:"])


@query("snp_projection", f"SELECT patient_id, {', '.join(SNP_NAMES)} FROM snps")
def snp_projection(spark, folder):
    return cols.select_prefix(view(spark, folder, "snps"), "rs", ["patient_id"])


@query("aligned_schema", "SELECT patient_id, CAST(0 AS INTEGER) AS rs9, rs1, CAST(0 AS INTEGER) AS rs8 FROM snps")
def aligned_schema(spark, folder):
    have = view(spark, folder, "snps").select("rs1", "patient_id")
    return cols.align_to(have, ["patient_id", "rs9", "rs1", "rs8"])


@query("registry_date_constant", "SELECT patient_id, DATE '2025-12-25' AS registry_date FROM pheno")
def registry_date_constant(spark, folder):
    return cols.add_registry_date(view(spark, folder, "pheno").select("patient_id"), "2025-12-25")


@query(
    "truncating_casts",
    "SELECT o_orderkey AS patient_id, CAST(trunc(o_totalprice) AS INTEGER) AS age, "
    "round(CAST(CAST(o_totalprice / 7 AS FLOAT) AS DOUBLE), 2) AS bmi FROM orders",
)
def truncating_casts(spark, folder):
    raw = table(spark, folder, "orders").selectExpr(
        "o_orderkey AS patient_id", "o_totalprice AS age", "o_totalprice / 7 AS bmi"
    )
    return rounded(cols.cast_columns(raw, ["patient_id", "age"], ["bmi"]), 2, "bmi")


@query(
    "numeric_coercion",
    "SELECT o_orderkey AS patient_id, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS dosage "
    "FROM orders",
)
def numeric_coercion(spark, folder):
    text = table(spark, folder, "orders").selectExpr(
        "o_orderkey AS patient_id", "CASE WHEN o_orderkey % 9 = 0 THEN 'x' ELSE CAST(o_custkey AS STRING) END AS dosage"
    )
    return cols.coerce_numbers(text, ["dosage"])


@query("feature_target_split", "SELECT patient_id, rs2, rs1, diabetes FROM snps")
def feature_target_split(spark, folder):
    return cols.split_target(view(spark, folder, "snps"), ["rs2", "rs1"])


@query(
    "feature_families",
    "SELECT feature, CASE WHEN starts_with(feature, 'rs') THEN 'Genotypic (SNP)' ELSE 'Phenotypic' END AS family, "
    "count(*) AS n FROM (SELECT 'rs1' AS feature FROM snps WHERE rs1 IS NOT NULL UNION ALL "
    "SELECT 'rs2' FROM snps UNION ALL SELECT 'diabetes' FROM snps WHERE diabetes IS NOT NULL) GROUP BY 1, 2",
)
def feature_families(spark, folder):
    values = long_values(view(spark, folder, "snps"), ["rs1", "rs2", "diabetes"])
    return cols.tag_family(values).groupBy("feature", "family").agg(F.count(F.lit(1)).alias("n"))


@query("known_rows", "SELECT patient_id, rs1, diabetes FROM snps WHERE rs1 IS NOT NULL AND diabetes IS NOT NULL")
def known_rows(spark, folder):
    return quality.drop_null_rows(view(spark, folder, "snps"), ["rs1", "diabetes"]).select(
        "patient_id", "rs1", "diabetes"
    )


@query(
    "clinical_range_check",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"check\", count(*) FILTER (WHERE coalesce(NOT ({c} BETWEEN {lo} AND {hi}), true)) AS violations "
        "FROM pheno"
        for c, (lo, hi) in {"age": (0, 60), "bmi": (10, 50), "hba1c_level": (4, 9), "blood_glucose_level": (40, 300)}.items()
    ),
)
def clinical_range_check(spark, folder):
    limits = {"age": (0, 60), "bmi": (10, 50), "hba1c_level": (4, 9), "blood_glucose_level": (40, 300)}
    return quality.range_violations(view(spark, folder, "pheno"), limits)


@query(
    "dosage_check",
    " UNION ALL ".join(
        f"SELECT '{s}' AS \"check\", count(*) FILTER (WHERE {s} NOT IN (0, 1, 2)) AS violations FROM snps"
        for s in SNP_NAMES
    ),
)
def dosage_check(spark, folder):
    return quality.dosage_violations(view(spark, folder, "snps"), SNP_NAMES)


@query("valid_dosage_rows", "SELECT patient_id, rs4 FROM snps WHERE rs4 IN (0, 1, 2)")
def valid_dosage_rows(spark, folder):
    return quality.valid_dosages(view(spark, folder, "snps"), "rs4").select("patient_id", "rs4")


@query(
    "snp_quality_control",
    " UNION ALL ".join(
        f"SELECT '{s}' AS snp, round(avg(CASE WHEN {s} IS NULL THEN 1 ELSE 0 END), 6) AS missing_rate, "
        f"round(avg({s}) / 2, 6) AS allele_frequency, avg(CASE WHEN {s} IS NULL THEN 1 ELSE 0 END) <= 0.1 "
        f"AND avg({s}) / 2 >= 0.01 AS kept FROM geno"
        for s in GENO_NAMES
    ),
)
def snp_quality_control(spark, folder):
    report = quality.snp_quality(view(spark, folder, "geno"), GENO_NAMES)
    return rounded(report.select("snp", "missing_rate", "allele_frequency", "kept"), 6, "missing_rate", "allele_frequency")


@query("duplicate_keys", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def duplicate_keys(spark, folder):
    return quality.duplicate_keys(table(spark, folder, "lineitem"), "l_orderkey")


@query("nonempty_table", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def nonempty_table(spark, folder):
    checked = quality.require_rows(table(spark, folder, "customer"), "customer")
    return checked.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


_EXTENSION_SQL = "lower(regexp_extract(path, '[^/.](\\.[^./]*)$', 1))"
_FORMAT_SQL = (
    "CASE WHEN data_type IS NULL OR data_type NOT IN ('phenotypic', 'genotypic', 'image') THEN 'invalid data type' "
    f"WHEN NOT ((data_type = 'phenotypic' AND {_EXTENSION_SQL} IN ('.csv', '.xlsx', '.json')) OR "
    f"(data_type = 'genotypic' AND {_EXTENSION_SQL} IN ('.csv', '.xlsx', '.json', '.vcf', '.bed', '.bim', '.fam')) OR "
    f"(data_type = 'image' AND {_EXTENSION_SQL} IN ('.jpg', '.jpeg', '.png', '.tif', '.tiff', '.dcm'))) "
    "THEN 'unsupported file format' END"
)
_DATE_SQL = (
    "CASE WHEN registry_date IS NOT NULL AND try_strptime(registry_date, '%Y-%m-%d') IS NULL "
    "THEN 'registry_date must be in YYYY-MM-DD format' END"
)


@query("upload_format_check", f"SELECT patient_id, {_FORMAT_SQL} AS problem FROM requests")
def upload_format_check(spark, folder):
    requests = view(spark, folder, "requests")
    return requests.select("patient_id", manifest.format_error(F.col("path"), F.col("data_type")).alias("problem"))


@query(
    "upload_file_presence",
    "SELECT c_mktsegment AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'file is missing or empty' ELSE '' END AS problem "
    "FROM customer GROUP BY c_mktsegment",
)
def upload_file_presence(spark, folder):
    path = scratch_path(spark, "uploads")
    customer = table(spark, folder, "customer")
    customer.where("c_mktsegment <> 'BUILDING'").repartition("c_mktsegment").write.partitionBy("c_mktsegment").option(
        "header", True
    ).csv(path)
    listing = manifest.file_sizes(spark, path).withColumn(
        "name", F.regexp_extract("path", "c_mktsegment=([^/]*)/", 1)
    )
    uploads = customer.select(F.col("c_mktsegment").alias("name")).distinct().select(
        "name", F.col("name").alias("path"), F.lit("phenotypic").alias("data_type"), F.lit(None).cast("string").alias("registry_date")
    )
    sizes = listing.groupBy("name").agg(F.sum("length").alias("length")).withColumnRenamed("name", "path")
    found = manifest.validate_manifest(uploads, sizes)
    missing = F.array_intersect("errors", F.array(F.lit("file is missing or empty")))
    return found.select("name", F.array_join(missing, "; ").alias("problem"))


@query(
    "registry_date_check",
    f"SELECT patient_id, CAST(try_strptime(registry_date, '%Y-%m-%d') AS DATE) AS day, {_DATE_SQL} AS problem FROM requests",
)
def registry_date_check(spark, folder):
    requests = view(spark, folder, "requests")
    return requests.select(
        "patient_id",
        registry_timestamp("registry_date").cast("date").alias("day"),
        quality.date_error(F.col("registry_date")).alias("problem"),
    )


@query(
    "upload_validation",
    f"SELECT patient_id, concat_ws('; ', {_FORMAT_SQL}, {_DATE_SQL}) AS problems FROM requests",
)
def upload_validation(spark, folder):
    validated = manifest.validate_manifest(view(spark, folder, "requests"))
    return validated.select("patient_id", F.array_join("errors", "; ").alias("problems"))


@query(
    "storage_policy",
    "SELECT patient_id, CASE WHEN NOT is_single_patient AND (NOT has_pheno OR NOT has_geno) THEN 'block' "
    "WHEN consent_to_store THEN 'store' WHEN is_single_patient THEN 'process_only' ELSE 'block' END AS action FROM requests",
)
def storage_policy(spark, folder):
    requests = view(spark, folder, "requests")
    return quality.with_storage_action(requests, has_pheno="has_pheno", has_geno="has_geno").select(
        "patient_id", "action"
    )


@query(
    "consent_check",
    "SELECT patient_id, concat_ws(' | ', "
    "CASE WHEN NOT consent_raw AND consent_integrate THEN 'integrate_without_raw' END, "
    "CASE WHEN NOT consent_raw AND consent_retrain THEN 'retrain_without_raw' END, "
    "CASE WHEN consent_integrate AND NOT consent_retrain THEN 'integrate_without_retrain' END, "
    "CASE WHEN consent_retrain AND NOT consent_integrate THEN 'retrain_without_integrate' END "
    ") AS problems FROM requests",
)
def consent_check(spark, folder):
    requests = view(spark, folder, "requests")
    errors = quality.consent_errors(F.col("consent_raw"), F.col("consent_integrate"), F.col("consent_retrain"))
    return requests.select("patient_id", F.array_join(errors, " | ").alias("problems"))


@query(
    "duplicate_patient_rejects",
    "SELECT patient_id FROM requests WHERE consent_raw AND patient_id IN (SELECT l_orderkey FROM lineitem)",
)
def duplicate_patient_rejects(spark, folder):
    stored = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("patient_id"))
    return quality.already_stored(view(spark, folder, "requests"), stored).select("patient_id")


@query(
    "new_patient_requests",
    "SELECT patient_id FROM requests WHERE NOT consent_raw OR patient_id NOT IN (SELECT l_orderkey FROM lineitem)",
)
def new_patient_requests(spark, folder):
    stored = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("patient_id"))
    return quality.not_yet_stored(view(spark, folder, "requests"), stored).select("patient_id")


@query(
    "iqr_outliers",
    "WITH v AS (SELECT *, l_extendedprice * l_extendedprice AS v FROM lineitem), "
    "q AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM v) "
    "SELECT l_returnflag, v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1) AS is_outlier, count(*) AS n "
    "FROM v, q GROUP BY 1, 2",
)
def iqr_outliers(spark, folder):
    line = table(spark, folder, "lineitem").withColumn("v", F.col("l_extendedprice") * F.col("l_extendedprice"))
    flagged = quality.flag_outliers(line.select("l_returnflag", "v"), "v")
    return flagged.groupBy("l_returnflag", "is_outlier").agg(F.count(F.lit(1)).alias("n"))


@query(
    "first_row",
    "SELECT patient_id, diabetes FROM snps ORDER BY patient_id LIMIT 1",
)
def first_row(spark, folder):
    return view(spark, folder, "snps").select("patient_id", "diabetes").orderBy("patient_id").limit(1)


@query(
    "newest_patients",
    f"SELECT patient_id, rs2, diabetes FROM snps WHERE patient_id IN (SELECT o_orderkey FROM orders WHERE {RECENT})",
)
def newest_patients(spark, folder):
    batch = table(spark, folder, "orders").where(RECENT).select(F.col("o_orderkey").alias("patient_id"))
    store = view(spark, folder, "snps")
    return store.join(batch, "patient_id", "left_semi").select("patient_id", "rs2", "diabetes")


@query("store_union", "SELECT patient_id, rs1, diabetes FROM snps UNION ALL SELECT patient_id, rs2, diabetes FROM snps")
def store_union(spark, folder):
    snps = view(spark, folder, "snps")
    new = snps.select("diabetes", "patient_id", F.col("rs2").alias("rs1"))
    return snps.select("patient_id", "rs1", "diabetes").unionByName(new)
