"""Genotype quality control and cleaning in long form, for any number of SNPs.

A long table holds one row per patient and SNP: key, ``snp``, ``dosage`` (null if missing). The
per-SNP statistics are a table of their own. They are broadcast while they are small; a table of
millions of SNPs is merged by (snp, salt), because every SNP has a row of every patient. The salts
follow the rows of the longest SNP.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.functions.columns import number, quoted
from cohortkit.operators import columns as cols
from cohortkit.operators.quality import raise_on_violations
from cohortkit.session import BROADCAST_BYTES, is_small, materialise

# Rows of one SNP that a task of a shuffled join should take.
SALT_ROWS = 200_000


def long_snp_quality(long: DataFrame) -> DataFrame:
    """Per SNP: missing rate, unfolded allele frequency, mean and invalid dosages, and what the filters keep.

    Counts combine before they are shuffled, so a SNP is one row per task. A row without a SNP name counts nowhere.
    """
    dosage = number(quoted("dosage"))
    rows = long.where("snp IS NOT NULL").groupBy("snp").agg(
        (1 - F.count(dosage) / F.count(F.lit(1))).alias("missing_rate"),
        F.avg(dosage).alias("mean_dosage"),
        F.count_if(~dosage.isin(*domain.DOSAGES)).alias("invalid"),
    )
    low_missing = F.coalesce(F.col("missing_rate") <= domain.MAX_MISSING_RATE, F.lit(False))
    frequent = F.coalesce(F.col("allele_frequency") >= domain.MIN_ALLELE_FREQUENCY, F.lit(False))
    return (
        rows.withColumn("allele_frequency", F.col("mean_dosage") / 2)
        .withColumn("passes_missing", low_missing)
        .withColumn("passes_frequency", frequent)
        .withColumn("kept", F.col("passes_missing") & F.col("passes_frequency"))
    )


def fit_long_genotypes(long: DataFrame) -> DataFrame:
    """``snp`` and ``mean_dosage`` of the SNPs that pass; raises on a dosage outside {0, 1, 2, null}.

    At most ten bad SNPs are named, whatever their number.
    """
    report = materialise(long_snp_quality(long), "snp-quality")
    bad = report.where("invalid > 0").select(F.col("snp").alias("check"), F.col("invalid").alias("violations"))
    raise_on_violations(bad.orderBy("check").limit(10), "invalid dosages")
    return report.where("kept").select("snp", "mean_dosage")


def clean_long_genotypes(
    long: DataFrame, fit: DataFrame | None = None, *, key: str = domain.KEY, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Key, ``snp`` and ``dosage`` of the quality-controlled SNPs, nulls filled with the cohort's mean dosage.

    ``fit`` (snp, mean_dosage) comes from ``fit_long_genotypes``, of this table unless given. A SNP that
    the fit lacks goes; other columns are left out.
    """
    cols.require_columns(long, [key, "snp", "dosage"])
    means = materialise(fit_long_genotypes(long) if fit is None else fit.select("snp", "mean_dosage"), "snp-means")
    rows = long.select(quoted(key), "snp", number(quoted("dosage")).alias("dosage"))
    if is_small(means, max_bytes):
        joined = rows.join(F.broadcast(means), "snp")
    else:
        longest = rows.where("snp IS NOT NULL").groupBy("snp").count().agg(F.max("count")).first()[0] or 0
        salts = -(-longest // SALT_ROWS) or 1
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64(quoted(key)), F.lit(salts)).cast("int"))
        spread = means.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = salted.join(spread.hint("merge"), ["snp", "_salt"])
    return joined.select(quoted(key), "snp", F.coalesce("dosage", "mean_dosage").alias("dosage"))


def wide_genotypes(long: DataFrame, snps: list[str], *, key: str = domain.KEY) -> DataFrame:
    """One row per key with a column for each of a few listed SNPs, as the wide operators take them."""
    return long.where(F.col("snp").isin(snps)).groupBy(quoted(key)).agg(
        *[F.max(F.when(F.col("snp") == s, F.col("dosage"))).alias(s) for s in snps]
    )
