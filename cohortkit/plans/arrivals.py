"""Arriving patients: check, score, then store what consent allows.

A batch has the raw phenotype and genotype columns of each patient in one row,
plus ``registry_date`` and the flags ``consent_raw``, ``consent_integrate`` and
``consent_retrain``. A bad row is rejected with its reasons; the rest go on.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.functions.columns import normal_name, number, quoted, registry_timestamp
from cohortkit.operators import columns as cols
from cohortkit.operators.cleaning import GenotypeFit, PhenotypeFit, clean_genotypes, clean_phenotypes
from cohortkit.operators.quality import absent_rows, consent_errors, date_error, keys_present
from cohortkit.operators.selection import Selection
from cohortkit.operators.training import score
from cohortkit.plans.cohort import train_from_store
from cohortkit.plans.featurize import build_features
from cohortkit.plans.store import CohortStore
from cohortkit.session import materialise
from cohortkit.sources.writers import append_audit, append_feature_store, append_table

CONSENTS = ["consent_raw", "consent_integrate", "consent_retrain"]

# Column in which a stream marks patients that an earlier micro-batch scored.
SCORED_BEFORE = "scored_before"


@dataclass
class Scoring:
    """Everything fitted on the cohort that a new patient needs."""

    pheno_fit: PhenotypeFit
    geno_fit: GenotypeFit
    selection: Selection
    model: PipelineModel


def join_arrivals(pheno: DataFrame, geno: DataFrame, requests: DataFrame, key: str = domain.KEY) -> DataFrame:
    """One row per request with its phenotype and genotype columns, where they exist."""
    renamed = cols.normalise_names(pheno).drop(domain.REGISTRY_DATE)
    return requests.join(renamed, key, "left").join(
        geno.withColumn("_has_genotype", F.lit(True)), key, "left"
    ).withColumn("has_genotype", F.coalesce("_has_genotype", F.lit(False))).drop("_has_genotype")


def arrival_errors(batch: DataFrame, scoring: Scoring) -> Column:
    """Reasons to reject a row: consent, date, missing genotype, values out of range."""
    raw, integrate, retrain = (F.coalesce(quoted(c), F.lit(False)) for c in CONSENTS)
    date = quoted(domain.REGISTRY_DATE).cast("string")
    out_of_range = [
        F.when(~number(quoted(c)).between(lo, hi), F.lit(f"invalid {c}"))
        for c, (lo, hi) in domain.CLINICAL_RANGES.items()
    ]
    bad_dosage = F.lit(False)
    for snp in scoring.geno_fit.snps:
        bad_dosage = bad_dosage | F.coalesce(~number(quoted(snp)).isin(*domain.DOSAGES), F.lit(False))
    checks = [
        F.when(date.isNull(), "registry_date is missing"),
        date_error(date),
        F.when(quoted(domain.TARGET).isNull() & retrain, f"label {domain.TARGET} is missing"),
        F.when(bad_dosage, "invalid dosage"),
        *out_of_range,
    ]
    if "has_genotype" in batch.columns:
        checks.append(F.when(~F.col("has_genotype"), "no matching genotype"))
    return F.concat(consent_errors(raw, integrate, retrain), F.array_compact(F.array(*checks)))


def check_arrivals(batch: DataFrame, scoring: Scoring, store: CohortStore) -> DataFrame:
    """Add ``errors`` to each row.

    Rows without a key, patients twice in the batch, patients whose raw or clean
    data is stored already and those marked as scored before are rejected too.
    """
    spark = batch.sparkSession
    key = domain.KEY
    known = batch.where(quoted(key).isNotNull())
    repeated = known.groupBy(key).agg((F.count(F.lit(1)) > 1).alias("_repeated"))
    checked = batch.withColumn("errors", arrival_errors(batch, scoring)).join(repeated, key, "left")
    extra = [
        F.when(quoted(key).isNull(), f"{key} is missing"),
        F.when(F.col("_repeated"), "patient occurs twice in the batch"),
    ]
    if SCORED_BEFORE in batch.columns:
        extra.append(F.when(F.col(SCORED_BEFORE), "patient was scored before"))
    tables = [t for t in (store.phenotypes, store.raw_keys) if spark.catalog.tableExists(t)]
    if tables:
        stored = reduce(DataFrame.unionByName, [keys_present(spark.table(t), known) for t in tables]).distinct()
        checked = checked.join(stored.withColumn("_stored", F.lit(True)), key, "left")
        extra.append(F.when(F.col("_stored") & quoted("consent_raw"), "patient is already stored"))
    return checked.withColumn("errors", F.concat("errors", F.array_compact(F.array(*extra)))).drop(
        "_repeated", "_stored"
    )


def clean_arrivals(valid: DataFrame, scoring: Scoring) -> tuple[DataFrame, DataFrame]:
    """Clean phenotype and genotype tables of the valid rows, by the cohort's fitted state."""
    snps = scoring.geno_fit.snps
    aside = [domain.REGISTRY_DATE, *CONSENTS, "has_genotype", "errors", SCORED_BEFORE, *domain.snp_columns(valid.columns)]
    pheno = clean_phenotypes(cols.drop_columns(valid, aside), scoring.pheno_fit, check=False)
    geno = clean_genotypes(cols.select_features(valid, snps, [domain.KEY]), scoring.geno_fit, check=False)
    dates = valid.select(
        domain.KEY,
        registry_timestamp(quoted(domain.REGISTRY_DATE).cast("string")).cast("date").alias(domain.REGISTRY_DATE),
        *CONSENTS,
    )
    return pheno.join(dates, domain.KEY), geno


def prepare_arrivals(batch: DataFrame, scoring: Scoring, store: CohortStore, *, label: str = "arrivals") -> tuple[DataFrame, DataFrame]:
    """The checked batch, and the clean, joined rows of its valid part; each is written once."""
    batch = batch.toDF(*[normal_name(c) for c in batch.columns])
    checked = materialise(check_arrivals(batch, scoring, store), label)
    pheno, geno = clean_arrivals(checked.where(F.size("errors") == 0), scoring)
    return checked, materialise(pheno.join(geno, domain.KEY), f"{label}-clean")


def arrival_results(checked: DataFrame, clean: DataFrame, scoring: Scoring) -> DataFrame:
    """Key, status, errors and probability of every row of a prepared batch."""
    scored = score(scoring.model, build_features(clean), scoring.selection.features)
    return (
        checked.select(domain.KEY, "errors")
        .join(scored, domain.KEY, "left")
        .select(
            domain.KEY,
            F.when(F.size("errors") > 0, "rejected").otherwise("scored").alias("status"),
            "errors",
            "y_prob",
        )
    )


def score_arrivals(batch: DataFrame, scoring: Scoring, store: CohortStore, *, label: str = "arrivals") -> DataFrame:
    """Check and score a batch; stores nothing. Returns key, status, errors and probability."""
    return arrival_results(*prepare_arrivals(batch, scoring, store, label=label), scoring)


def store_arrivals(batch: DataFrame, results: DataFrame, scoring: Scoring, store: CohortStore) -> None:
    """Store the scored rows of a batch as far as their consent goes.

    Used where the clean rows of the scoring run are gone, as when a stream runs a batch again.
    """
    key = domain.KEY
    batch = batch.toDF(*[normal_name(c) for c in batch.columns])
    accepted = batch.join(results.where("status = 'scored'").select(key), key, "left_semi")
    pheno, geno = clean_arrivals(accepted, scoring)
    store_clean(materialise(pheno.join(geno, key), "arrivals-clean"), scoring, store)


def store_clean(clean: DataFrame, scoring: Scoring, store: CohortStore) -> None:
    """Store clean, joined rows as far as their consent goes.

    Raw consent leaves the key and an audit row; integration consent puts a row into the clean and
    merged tables, retraining consent on top puts it into the feature store. Keys that
    a table holds already are left out, so running this again stores nothing twice.
    """
    key, snps = domain.KEY, scoring.geno_fit.snps
    kept = clean.where("consent_raw")
    uploads = absent_rows(kept, store.raw_keys, key).select(
        F.concat(F.lit("patient_"), F.col(key).cast("string")).alias("path"), F.lit("patient").alias("data_type"),
        F.col(key).cast("string").alias("patient_id"), domain.REGISTRY_DATE,
        F.col("consent_raw").alias("consent_raw_storage"), F.lit("arrival").alias("source"),
    )
    append_audit(uploads, store.audit, folder=store.folder)
    joined = clean.where("consent_integrate").drop(*CONSENTS)
    tables = {
        store.raw_keys: kept.select(key),
        store.phenotypes: joined.drop(*snps),
        store.genotypes: joined.select(key, *snps),
        store.merged: joined,
    }
    for name, rows in tables.items():
        append_table(absent_rows(rows, name, key), name, folder=store.folder)
    again = clean.where("consent_integrate and consent_retrain").drop(*CONSENTS)
    features = cols.split_target(build_features(again), scoring.selection.features, domain.TARGET, key)
    append_feature_store(absent_rows(features, store.features, key), store.features, folder=store.folder)


def process_arrivals(batch: DataFrame, scoring: Scoring, store: CohortStore, *, label: str = "arrivals") -> DataFrame:
    """Score a batch, then store what consent allows; the scores never depend on what was stored."""
    checked, clean = prepare_arrivals(batch, scoring, store, label=label)
    results = materialise(arrival_results(checked, clean, scoring), f"{label}-scores")
    store_clean(clean, scoring, store)
    return results


def retrain(spark: SparkSession, scoring: Scoring, store: CohortStore, model_path: str, seen: int, **options) -> tuple[Scoring, bool]:
    """Train anew if the feature store holds more than the ``seen`` rows of the last training.

    Returns the scoring state, with the new model if there is one, and whether there is.
    """
    if spark.table(store.features).count() <= seen:
        return scoring, False
    return replace(scoring, model=train_from_store(spark, store, model_path, **options).model), True
