"""Feature selection by correlation and variance."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.operators import columns as cols
from cohortkit.operators.correlation import (
    correlation_pairs,
    redundant_features,
    target_correlations,
)
from cohortkit.operators.snp import dosage_variance

LOG_SCHEMA = "family string, feature string, status string, reason string, rank int, thresholds map<string,double>"


def weak_target_features(correlations: DataFrame, threshold: float) -> DataFrame:
    """Features below the target-correlation threshold; an undefined correlation is kept out of this list."""
    return correlations.where(F.coalesce(F.col("abs_r") < threshold, F.lit(False))).select("feature")


def snp_filter_chain(df: DataFrame, snps: Sequence[str], target: str, thresholds: dict[str, float]) -> DataFrame:
    """Variance and target-correlation filters per SNP: ``snp``, ``variance``, ``abs_r``, ``passes``.

    An undefined value fails. Redundancy among the survivors is a separate step.
    """
    listed = F.array(*[F.lit(c) for c in snps])
    rows = (
        dosage_variance(df, snps)
        .join(target_correlations(df, snps, target).withColumnRenamed("feature", "snp"), "snp")
        .withColumn("position", (F.array_position(listed, F.col("snp")) - 1).cast("int"))
    )
    varied = F.coalesce(F.col("variance") >= thresholds["snp_variance_threshold"], F.lit(False))
    linked = F.coalesce(F.col("abs_r") >= thresholds["snp_target_corr_threshold"], F.lit(False))
    return rows.select("position", "snp", "variance", "abs_r", (varied & linked).alias("passes"))


@dataclass
class Selection:
    """Selected and dropped features with the reason for each drop."""

    phenotypes: list[str] = field(default_factory=list)
    dropped_phenotypes: dict[str, str] = field(default_factory=dict)
    snps: list[str] = field(default_factory=list)
    dropped_snps: dict[str, str] = field(default_factory=dict)
    thresholds: dict[str, float] = field(default_factory=lambda: dict(domain.SELECTION_THRESHOLDS))

    @property
    def features(self) -> list[str]:
        return [*self.phenotypes, *self.snps]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The selection log: one row per offered feature."""
        rows = []
        for kind, kept, gone in (
            ("phenotypic", self.phenotypes, self.dropped_phenotypes),
            ("genotype", self.snps, self.dropped_snps),
        ):
            limits = {k: float(v) for k, v in self.thresholds.items() if k.startswith("snp") == (kind == "genotype")}
            rows += [(kind, f, "selected", None, i, limits) for i, f in enumerate(kept)]
            rows += [(kind, f, "dropped", why, i, limits) for i, (f, why) in enumerate(gone.items())]
        return spark.createDataFrame(rows, LOG_SCHEMA)

    @classmethod
    def from_frame(cls, log: DataFrame) -> Selection:
        """Read a selection log back (one row per feature)."""
        found = cls(thresholds={})
        for r in log.orderBy("family", "status", "rank").collect():
            pheno = r["family"] == "phenotypic"
            if r["status"] == "selected":
                (found.phenotypes if pheno else found.snps).append(r["feature"])
            else:
                (found.dropped_phenotypes if pheno else found.dropped_snps)[r["feature"]] = r["reason"]
            found.thresholds.update(r["thresholds"] or {})
        return found


def fit_selection(
    df: DataFrame,
    phenotypes: Sequence[str] = tuple(domain.PHENOTYPE_FEATURES),
    snps: Sequence[str] | None = None,
    target: str = domain.TARGET,
    **thresholds: float,
) -> Selection:
    """Select features on a cohort.

    Phenotypes: drop those redundant with an earlier one and those weakly
    correlated with the target. SNPs: variance, then target correlation, then
    redundancy among the survivors. Only per-feature statistics reach the driver.
    """
    if not isinstance(target, str):
        raise ValueError(f"target must be a column name, not {type(target).__name__}")
    snps = domain.snp_columns(df.columns) if snps is None else list(snps)
    cols.require_columns(df, [target, *phenotypes, *snps])
    limits = {**domain.SELECTION_THRESHOLDS, **thresholds}
    unknown = set(limits) - set(domain.SELECTION_THRESHOLDS)
    if unknown:
        raise ValueError(f"unknown thresholds: {sorted(unknown)}")
    phenotypes = list(phenotypes)
    dropped: dict[str, str] = {}
    if phenotypes:
        # The target is one more column of the grid, so one scan gives both kinds of pair.
        pairs = correlation_pairs(df, [*phenotypes, target])
        to_target = F.col("position_b") == len(phenotypes)
        strength = F.abs("r")
        weak = to_target & (strength < limits["phenotype_target_corr_threshold"])
        redundant = ~to_target & (strength > limits["phenotype_correlation_threshold"])
        gone = pairs.select(
            F.when(weak, F.struct(F.col("feature_a").alias("feature"), F.lit("weak_target_correlation").alias("reason")))
            .when(redundant, F.struct(F.col("feature_b").alias("feature"), F.lit("redundant").alias("reason")))
            .alias("gone")
        )
        # Redundant is the smaller text, so it is the reason named for a feature that is both.
        found = gone.where(F.col("gone").isNotNull()).groupBy("gone.feature").agg(F.min("gone.reason").alias("reason"))
        dropped = {r["feature"]: r["reason"] for r in found.orderBy("feature").collect()}
    kept_snps: list[str] = []
    dropped_snps: dict[str, str] = {}
    if snps:
        chain = {r["snp"]: r["passes"] for r in snp_filter_chain(df, snps, target, limits).collect()}
        passing = [s for s in snps if chain[s]]
        redundant_snps = set()
        if len(passing) > 1:
            limit = limits["snp_correlation_threshold"]
            found = redundant_features(correlation_pairs(df, passing, above=limit), limit)
            redundant_snps = {r["feature"] for r in found.collect()}
        kept_snps = [s for s in passing if s not in redundant_snps]
        kept = set(kept_snps)
        dropped_snps = {
            s: "redundant" if s in redundant_snps else "low_variance_or_weak_target"
            for s in snps
            if s not in kept
        }
    return Selection([c for c in phenotypes if c not in dropped], dropped, kept_snps, dropped_snps, limits)
