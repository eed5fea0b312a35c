"""Sinks: files, replaced and appended tables, the feature store and logs."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.functions.columns import text_sql
from cohortkit.operators.columns import require_columns
from cohortkit.operators.selection import Selection
from cohortkit.sources.readers import PREDICTION_COLUMNS, table_exists


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, replacing what is there."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def replace_table(
    df: DataFrame,
    name: str,
    *,
    buckets: int | None = None,
    key: str = domain.KEY,
    folder: str | None = None,
    check: Callable[[DataFrame], None] | None = None,
) -> None:
    """Replace a table as a whole, also when ``df`` reads that table.

    The new content is written under another name and passes ``check`` (which reads
    the written table, so nothing is computed twice); if the job or the check fails,
    the old table stays. ``buckets`` stores it bucketed by the key: joins of tables
    with equal buckets need no shuffle. ``folder`` places the files there instead of
    in the warehouse.

    A table with the same columns and buckets is then pointed at the new files, one
    change of the catalog, so a reader finds the old or the new content and never
    none. The files before stay for readers that began earlier, until the next
    replacement. A table whose layout changes is set aside under ``<name>__old``
    while the new one takes the name; a run that finds only the table set aside gives
    it its name back first.
    """
    spark = df.sparkSession
    if not table_exists(spark, name) and table_exists(spark, f"{name}__old"):
        spark.sql(f"ALTER TABLE {name}__old RENAME TO {name}")
    staged = f"{name}__{uuid.uuid4().hex[:8]}"
    present = table_exists(spark, name)
    place = folder or (_database_folder(spark, name) if present else None)
    writer = df.write
    if buckets:
        writer = writer.bucketBy(buckets, key).sortBy(key)
    if place:
        writer = writer.option("path", f"{place.rstrip('/')}/{staged}")
    writer.saveAsTable(staged)
    if check:
        try:
            check(spark.table(staged))
        except Exception:
            _drop_with_files(spark, staged)
            raise
    if present and _layout(spark, name) == _layout(spark, staged):
        _point(spark, name, staged)
        return
    aside = f"{name}__old"
    if present:
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
        spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    if table_exists(spark, aside):
        _drop_with_files(spark, aside)


# Table property that names the files of the content before.
_EARLIER_FILES = "cohortkit.earlier_files"


def _database_folder(spark: SparkSession, name: str) -> str:
    database = name.rpartition(".")[0] or spark.catalog.currentDatabase()
    return spark.catalog.getDatabase(database).locationUri


def _details(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def _layout(spark: SparkSession, name: str) -> tuple:
    """What two tables must share for one to take over the other's files."""
    details = _details(spark, name)
    columns = [(f.name, f.dataType.json()) for f in spark.table(name).schema.fields]
    return columns, [details.get(k) for k in ("Provider", "Num Buckets", "Bucket Columns", "Sort Columns")]


def _earlier_files(spark: SparkSession, name: str) -> str | None:
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return properties.get(_EARLIER_FILES)


def _point(spark: SparkSession, name: str, staged: str) -> None:
    """Let a table read the files of a staged one, whose entry then goes.

    A run that ends between two of these steps leaves the table whole, before or
    after the change, and at most a folder or an entry that nothing reads.
    """
    before, oldest = _details(spark, name)["Location"], _earlier_files(spark, name)
    after = _details(spark, staged)["Location"]
    spark.sql(f"ALTER TABLE {name} SET LOCATION {text_sql(after)}")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_EARLIER_FILES}' = {text_sql(before)})")
    spark.sql(f"DROP TABLE {staged}")  # external, so its files stay
    if oldest and oldest not in (before, after):
        _delete_files(spark, oldest)


def _drop_with_files(spark: SparkSession, name: str) -> None:
    """Drop a table, the files of an external one and those of its content before."""
    details, oldest = _details(spark, name), _earlier_files(spark, name)
    spark.sql(f"DROP TABLE {name}")
    if details.get("Type") == "EXTERNAL" and details.get("Location"):
        _delete_files(spark, details["Location"])
    if oldest:
        _delete_files(spark, oldest)


def _delete_files(spark: SparkSession, location: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def append_table(df: DataFrame, name: str, *, folder: str | None = None) -> None:
    """Append rows, matching columns by name; creates the table if it is missing."""
    spark = df.sparkSession
    if not table_exists(spark, name):
        replace_table(df, name, folder=folder)
        return
    stored = spark.table(name).columns
    if set(stored) != set(df.columns):
        raise ValueError(f"columns of {name} differ: {sorted(set(stored) ^ set(df.columns))}")
    df.select(*[f"`{c}`" for c in stored]).write.insertInto(name)


def append_feature_store(df: DataFrame, name: str, *, folder: str | None = None) -> None:
    """Append to the feature store; the column list and its order must be equal."""
    spark = df.sparkSession
    if table_exists(spark, name) and spark.table(name).columns != df.columns:
        raise ValueError("feature schema mismatch when appending to the feature store")
    append_table(df, name, folder=folder)


def rebuild_merged(pheno_table: str, geno_table: str, name: str, spark: SparkSession, *, key: str = domain.KEY, folder: str | None = None) -> DataFrame:
    """Rebuild the merged table as the join of the stored clean tables."""
    joined = spark.table(pheno_table).join(spark.table(geno_table), key)
    replace_table(joined, name, folder=folder)
    return spark.table(name)


def export_table(spark: SparkSession, name: str, path: str) -> None:
    """Export a table to CSV."""
    write_csv(spark.table(name), path)


def save_predictions(predictions: DataFrame, path: str) -> None:
    """Keyed test predictions, one table."""
    require_columns(predictions, PREDICTION_COLUMNS)
    predictions.write.mode("overwrite").parquet(path)


def save_selection(selection: Selection, spark: SparkSession, path: str) -> None:
    """The selection log."""
    selection.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(path)


def audit_rows(manifest: DataFrame) -> DataFrame:
    """Audit entry per upload, with a generated id and the current time."""
    return manifest.select(
        F.expr("uuid()").alias("id"),
        F.col("patient_id").cast("string").alias("patient_id"),
        F.element_at(F.split("path", "/"), -1).alias("filename"),
        "data_type",
        "source",
        F.col("registry_date").cast("string").alias("registry_date"),
        F.coalesce(F.col("consent_raw_storage").cast("boolean"), F.lit(False)).alias("consent_raw_storage"),
        F.col("patient_id").isNotNull().alias("is_single_patient"),
        F.current_timestamp().alias("uploaded_at"),
    )


def append_audit(manifest: DataFrame, name: str, *, folder: str | None = None) -> None:
    """Record uploads, also those without storage consent."""
    append_table(audit_rows(manifest), name, folder=folder)
