"""Joining phenotypes and genotypes on the patient key."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortkit import domain
from cohortkit.operators import columns as cols
from cohortkit.operators.quality import duplicate_keys
from cohortkit.session import broadcast_if_small


def join_cohort(pheno: DataFrame, geno: DataFrame, key: str = domain.KEY) -> DataFrame:
    """Patients present on both sides; Spark picks the join from the table sizes."""
    return pheno.join(geno, key, "inner")


def join_new_patients(pheno: DataFrame, geno: DataFrame, key: str = domain.KEY) -> DataFrame:
    """The same join for arriving patients.

    The arriving phenotypes are written once and broadcast if small, so a large
    genotype table is filtered in place and not shuffled.
    """
    return broadcast_if_small(pheno).join(geno, key, "inner").select(
        *[pheno.columns[i] for i in range(len(pheno.columns))],
        *[c for c in geno.columns if c != key],
    )


def unmatched(left: DataFrame, right: DataFrame, key: str = domain.KEY) -> DataFrame:
    """Rows of ``left`` whose key has no partner."""
    return left.join(right.select(key), key, "left_anti")


def require_unique_keys(df: DataFrame, what: str, key: str = domain.KEY) -> None:
    """Raise if a key repeats; reads at most a few of the repeated keys."""
    cols.require_columns(df, [key])
    repeated = duplicate_keys(df, key).limit(3).collect()
    if repeated:
        raise ValueError(f"duplicate {key} in {what}, such as {[r[key] for r in repeated]}")


def integrate(pheno: DataFrame, geno: DataFrame, registry_date: str | None, key: str = domain.KEY) -> DataFrame:
    """Check keys, date the phenotypes and join."""
    require_unique_keys(pheno, "phenotypes", key)
    require_unique_keys(geno, "genotypes", key)
    return join_cohort(cols.add_registry_date(pheno, registry_date), geno, key)
