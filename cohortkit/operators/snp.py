"""SNP summaries and the SNP association scan.

Wide genotype tables are counted into one small cube (snp, dosage, target); every
summary then works on the cube. Long tables (one row per patient and SNP) enter
at the same place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.functions.columns import number_sql, quoted, text_sql
from cohortkit.functions.tails import chi2_p
from cohortkit.operators.distribution import histogram
from cohortkit.operators.hypothesis import chi_square, fdr_adjust


def snps_or_raise(df: DataFrame, prefix: str = domain.SNP_PREFIX) -> list[str]:
    """The SNP columns; an error if there is none."""
    snps = domain.snp_columns(df.columns, prefix)
    if not snps:
        raise ValueError(f"no SNP among the columns, whose names start with {prefix!r}")
    return snps


def to_long(df: DataFrame, snps: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, SNP), null dosages included: ``keep``, ``snp``, ``dosage``."""
    pairs = ", ".join(f"named_struct('snp', {text_sql(c)}, 'dosage', {number_sql(c)})" for c in snps)
    return df.select(*[quoted(k) for k in keep], F.explode(F.expr(f"array({pairs})")).alias("_p")).select(
        *[quoted(k) for k in keep], "_p.snp", "_p.dosage"
    )


def count_cube(long: DataFrame, target: str = domain.TARGET) -> DataFrame:
    """Rows per (snp, dosage, target); null dosages and null targets keep their own cells."""
    return long.groupBy("snp", "dosage", quoted(target).cast("int").alias("target")).agg(
        F.count(F.lit(1)).alias("n")
    )


def snp_cube(df: DataFrame, target: str = domain.TARGET, snps: Sequence[str] | None = None) -> DataFrame:
    """The count cube of a wide table."""
    return count_cube(to_long(df, snps or snps_or_raise(df), [target]), target)


def snp_moments(df: DataFrame, snps: Sequence[str] | None = None) -> DataFrame:
    """Folded allele frequency and sample variance per SNP, straight from the wide columns."""
    snps = list(snps or snps_or_raise(df))
    per_snp = ", ".join(
        f"named_struct('snp', {text_sql(c)}, 'm', avg({number_sql(c)}), 'variance', var_samp({number_sql(c)}))" for c in snps
    )
    rows = df.selectExpr(f"array({per_snp}) AS _snps").select(F.inline("_snps"))
    p = F.col("m") / 2
    return rows.select("snp", F.least(p, 1 - p).alias("maf"), "variance")


def minor_allele_frequency(df: DataFrame, snps: Sequence[str] | None = None) -> DataFrame:
    """min(p, 1 - p) with p = mean dosage / 2, per SNP."""
    return snp_moments(df, snps).select("snp", "maf")


def dosage_variance(df: DataFrame, snps: Sequence[str] | None = None) -> DataFrame:
    """Sample variance of the dosage, per SNP."""
    return snp_moments(df, snps).select("snp", "variance")


def maf_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    """Histogram of allele frequencies over the SNPs."""
    return histogram(minor_allele_frequency(df), "maf", bins)


def variance_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    """Histogram of dosage variances over the SNPs."""
    return histogram(dosage_variance(df), "variance", bins)


def association(cube: DataFrame, *, alpha: float = domain.ALPHA) -> DataFrame:
    """Chi-square scan over the cube: ``snp``, ``statistic``, ``dof``, ``p_value``, ``p_fdr``, ``significant``.

    Only dosages 0, 1, 2 with a known target count; SNPs without a testable table
    are left out.
    """
    counts = (
        cube.where(F.col("dosage").isin(*domain.DOSAGES) & F.col("target").isin(0, 1))
        .groupBy("snp", F.col("dosage").alias("level"))
        .agg(
            F.sum(F.when(F.col("target") == 0, F.col("n")).otherwise(0)).alias("n_0"),
            F.sum(F.when(F.col("target") == 1, F.col("n")).otherwise(0)).alias("n_1"),
        )
    )
    tested = chi_square(counts, key="snp", with_p=False).where("statistic IS NOT NULL")
    tested = tested.select("snp", "statistic", "dof", chi2_p("statistic", F.col("dof").cast("double")).alias("p_value"))
    return fdr_adjust(tested, alpha=alpha)


def snp_association(df: DataFrame, target: str = domain.TARGET, *, alpha: float = domain.ALPHA) -> DataFrame:
    """Association scan of a wide table, ordered by adjusted p-value."""
    snps = snps_or_raise(df)
    return association(snp_cube(df, target, snps), alpha=alpha).orderBy("p_fdr", "snp")


def significant_snps(df: DataFrame, target: str = domain.TARGET, *, alpha: float = domain.ALPHA) -> DataFrame:
    """SNPs whose adjusted p-value is at most alpha; empty if none."""
    return snp_association(df, target, alpha=alpha).where("significant").select("snp", "p_fdr")


def top_significant(scan: DataFrame, top_k: int = 10) -> DataFrame:
    """The ``top_k`` significant SNPs by adjusted p-value."""
    return scan.where("significant").orderBy("p_fdr", "snp").limit(top_k).select("snp", "p_fdr")


def _dosage_grid(scan: DataFrame | None, cells: DataFrame, top_k: int) -> DataFrame:
    if scan is None:
        return cells
    return cells.join(F.broadcast(top_significant(scan, top_k).select("snp")), "snp", "left_semi")


def genotype_frequencies(cube: DataFrame, scan: DataFrame | None = None, top_k: int = 10) -> DataFrame:
    """Share of dosages 0, 1, 2 per SNP (``freq_0`` .. ``freq_2``), of the top significant SNPs if a scan is given.

    Rows with an unknown target count here.
    """
    cells = _dosage_grid(scan, cube.where(F.col("dosage").isin(*domain.DOSAGES)), top_k)
    shares = [
        (F.sum(F.when(F.col("dosage") == d, F.col("n")).otherwise(0)) / F.sum("n")).alias(f"freq_{d}")
        for d in domain.DOSAGES
    ]
    return cells.groupBy("snp").agg(*shares)


def genotype_outcome_shares(cube: DataFrame, scan: DataFrame | None = None, top_k: int = 10) -> DataFrame:
    """Per SNP, the share of each dosage x outcome among its valid rows: ``snp``, ``dosage``, ``target``, ``share``."""
    valid = cube.where(F.col("dosage").isin(*domain.DOSAGES) & F.col("target").isNotNull())
    valid = _dosage_grid(scan, valid, top_k)
    grid = [(d, t) for d in domain.DOSAGES for t in (0, 1)]
    share = [
        F.sum(F.when((F.col("dosage") == d) & (F.col("target") == t), F.col("n")).otherwise(0)) / F.sum("n")
        for d, t in grid
    ]
    wide = valid.groupBy("snp").agg(F.array(*[
        F.struct(F.lit(d).alias("dosage"), F.lit(t).alias("target"), s.alias("share"))
        for (d, t), s in zip(grid, share)
    ]).alias("_cells"))
    return wide.select("snp", F.inline("_cells"))
