"""Upload ingestion end to end, and CSV uploads with differing headers, over files written from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.plans.ingest import ingest_uploads
from cohortkit.plans.store import CohortStore
from cohortkit.session import scratch_path
from cohortkit.sources import manifest, readers
from workload.registry import query
from workload.tables import view

_HEADER = list(domain.RAW_PHENOTYPE_TYPES)
_EVEN, _ODD = "patient_id % 2 = 0", "patient_id % 2 <> 0"


def _publish(spark, written: str, target: str) -> None:
    """Give the one part file below ``written`` its own name, as an upload has."""
    jvm = spark.sparkContext._jvm
    files = jvm.org.apache.hadoop.fs.Path(written).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = [s.getPath() for s in files.listStatus(jvm.org.apache.hadoop.fs.Path(written)) if s.getPath().getName().startswith("part-")]
    goal = jvm.org.apache.hadoop.fs.Path(target)
    files.mkdirs(goal.getParent())
    if len(parts) != 1 or not files.rename(parts[0], goal):
        raise ValueError(f"{target} was not written")


def _csv(spark, df: DataFrame, target: str) -> None:
    path = scratch_path(spark, "upload")
    df.coalesce(1).write.option("header", True).csv(path)
    _publish(spark, path, target)


def _lines(spark, df: DataFrame, target: str) -> None:
    """One text file of the column ``value``, in the order of ``at``."""
    path = scratch_path(spark, "upload")
    df.repartition(1).sortWithinPartitions("at").select("value").write.text(path)
    _publish(spark, path, target)


def _json_array(df: DataFrame) -> DataFrame:
    """Lines of a JSON array of all rows."""
    first = df.agg(F.min("patient_id")).scalar()
    opening = F.when(F.col("patient_id") == first, "[").otherwise(",")
    rows = df.select(F.col("patient_id").alias("at"), F.concat(opening, F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).alias("value"))
    return rows.unionByName(df.sparkSession.createDataFrame([(1 << 62, "]")], "at long, value string"))


def _text(spark, lines: list[str], target: str) -> None:
    _lines(spark, spark.createDataFrame(list(enumerate(lines)), "at int, value string"), target)


def _upload_files(spark, folder: str) -> str:
    """Files of every kind that ingestion tells apart; returns their folder."""
    root = f"{scratch_path(spark, 'uploads')}/files"
    pheno = view(spark, folder, "pheno")
    _csv(spark, pheno.where(_EVEN), f"{root}/good.csv")
    _csv(spark, pheno.where(_ODD).select(*[F.col(f"`{c}`") for c in reversed(_HEADER)]), f"{root}/UPPER.CSV")
    _lines(spark, _json_array(pheno.where(_ODD)), f"{root}/array.json")
    _lines(spark, _json_array(pheno.where(_EVEN).select("patient_id", "bmi")), f"{root}/short.JSON")
    quoted = pheno.where(_EVEN).select("patient_id", F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in _HEADER]).alias("value"))
    header = ",".join([*(f'"{c}"' for c in _HEADER), '"a ""note"", with a comma"'])
    heading = spark.createDataFrame([(-1, header)], "at long, value string")
    _lines(spark, quoted.select(F.col("patient_id").alias("at"), F.concat("value", F.lit(",x")).alias("value")).unionByName(heading), f"{root}/quoted.csv")
    _text(spark, [",".join(_HEADER)], f"{root}/header.csv")
    _text(spark, ["patient_id,bmi", "1,2"], f"{root}/few.csv")
    _text(spark, ["{not json"], f"{root}/broken.json")
    _text(spark, ["x"], f"{root}/scan.PNG")
    return root


# name, kind, patient, date, consent
_UPLOADS = [
    ("good.csv", "phenotypic", None, None, True), ("UPPER.CSV", "phenotypic", None, None, False),
    ("array.json", "phenotypic", None, None, True), ("short.JSON", "phenotypic", None, None, True),
    ("quoted.csv", "phenotypic", None, None, True), ("header.csv", "phenotypic", None, None, True),
    ("few.csv", "phenotypic", "7", "2025-12-25", True), ("broken.json", "phenotypic", "8", "2025-12-25", True),
    ("scan.PNG", "image", "9", "2025-12-25", False), ("undated.png", "image", "10", None, True), ("gone.csv", "genotypic", "11", "25-12-2025", True),
]
_SQL_ROWS = ", ".join("({}, {})".format(repr(n), "NULL" if p is None else repr(p)) for n, _, p, _, _ in _UPLOADS)
_FULL = ", ".join(_HEADER)
_PART = ", ".join(c for c in _HEADER if c not in ("patient_id", "bmi"))


@query(
    "ingest_uploads",
    f"WITH uploads(name, patient) AS (VALUES {_SQL_ROWS}), "
    f"even AS (SELECT count(*) AS n FROM pheno WHERE {_EVEN}), odd AS (SELECT count(*) AS n FROM pheno WHERE {_ODD}), "
    "told AS (SELECT name, patient, CASE name WHEN 'good.csv' THEN (SELECT n FROM even) WHEN 'quoted.csv' THEN (SELECT n FROM even) "
    "WHEN 'short.JSON' THEN (SELECT n FROM even) WHEN 'UPPER.CSV' THEN (SELECT n FROM odd) WHEN 'array.json' THEN (SELECT n FROM odd) "
    "WHEN 'header.csv' THEN 0 WHEN 'few.csv' THEN 1 WHEN 'broken.json' THEN 0 END AS n_rows, "
    f"CASE name WHEN 'short.JSON' THEN 'missing columns: {_PART}' WHEN 'few.csv' THEN 'missing columns: {_PART}' "
    f"WHEN 'header.csv' THEN 'tabular file has no rows' WHEN 'broken.json' THEN 'tabular file has no rows; missing columns: {_FULL}' "
    "WHEN 'undated.png' THEN 'file is missing or empty; registry_date is missing' "
    "WHEN 'gone.csv' THEN 'registry_date must be in YYYY-MM-DD format; file is missing or empty' ELSE '' END AS problems FROM uploads) "
    "SELECT name, n_rows, problems, problems = '' AS audited, problems = '' AND patient IS NOT NULL AS audited_as_patient FROM told",
)
def ingest_uploads_query(spark, folder):
    """Every upload with its rows, its problems, and whether the audit table lists it."""
    root = _upload_files(spark, folder)
    rows = [(f"{root}/{n}", k, p, d, c, "ui") for n, k, p, d, c in _UPLOADS]
    uploads = spark.createDataFrame(
        rows, "path string, data_type string, patient_id string, registry_date string, consent_raw_storage boolean, source string")
    database, place = f"uploads_{uuid.uuid4().hex[:12]}", scratch_path(spark, "store")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{place}'")
    store = CohortStore(database, place)
    checked = ingest_uploads(uploads, root, store)
    name = F.element_at(F.split("path", "/"), -1).alias("name")
    held = manifest.file_contents(spark, root).select(name, "n_rows")
    listed = spark.table(store.audit).select(F.col("filename").alias("name"), "is_single_patient")
    return checked.select(name, F.array_join("errors", "; ").alias("problems")).join(held, "name", "left").join(listed, "name", "left").select(
        "name", "n_rows", "problems", F.col("is_single_patient").isNotNull().alias("audited"),
        F.coalesce("is_single_patient", F.lit(False)).alias("audited_as_patient"))


@query(
    "csv_files_by_name",
    f"SELECT patient_id, gender, age, CASE WHEN {_EVEN} THEN bmi END AS bmi, diabetes FROM pheno",
)
def csv_files_by_name(spark, folder):
    """Two files with other column orders, one of them without a column."""
    root = f"{scratch_path(spark, 'uploads')}/files"
    pheno = view(spark, folder, "pheno").select("patient_id", "gender", "age", "bmi", "diabetes")
    _csv(spark, pheno.where(_EVEN), f"{root}/a.csv")
    _csv(spark, pheno.where(_ODD).select("diabetes", "age", "patient_id", "gender"), f"{root}/b.csv")
    return readers.read_phenotypes(spark, root).select("patient_id", "gender", "age", "bmi", "diabetes")
