"""Upload ingestion: validate a manifest against its files, record the valid uploads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.plans.store import CohortStore
from cohortkit.session import materialise
from cohortkit.sources.manifest import file_contents, file_sizes, valid_uploads, validate_manifest
from cohortkit.sources.writers import append_audit


def ingest_uploads(manifest: DataFrame, folder: str, store: CohortStore) -> DataFrame:
    """Check every upload against the files below ``folder``; audit the valid ones, with or without consent.

    A single patient's upload needs a registry date. Returns the manifest with ``errors``.
    """
    spark = manifest.sparkSession
    checked = validate_manifest(manifest, file_sizes(spark, folder), file_contents(spark, folder, manifest.select("path")))
    undated = F.when(F.col("patient_id").isNotNull() & F.col("registry_date").isNull(), "registry_date is missing")
    checked = checked.withColumn("errors", F.concat("errors", F.array_compact(F.array(undated))))
    checked = materialise(checked, "uploads")
    append_audit(valid_uploads(checked), store.audit, folder=store.folder)
    return checked
