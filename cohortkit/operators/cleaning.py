"""Imputation, encoding, and the two table cleaners with fitted state.

Statistics are fitted on the cohort and applied to later patients, so that one
new row is coded and filled like the rows the model saw.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.functions.columns import normal_name, number, one_hot_code, quoted
from cohortkit.operators import columns as cols
from cohortkit.operators import quality
from cohortkit.operators.ordering import exact_quantiles, running
from cohortkit.session import materialise, scratch_path


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Remove rows that repeat in every column."""
    return df.dropDuplicates()


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls by a constant per column."""
    return df.fillna(dict(values))


def column_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median per column: ``feature``, ``median``."""
    return exact_quantiles(df, columns, [0.5]).select("feature", F.col("quantiles")[0].alias("median"))


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls by the column's exact median."""
    pairs = F.map_from_entries(F.collect_list(F.struct("feature", "median")))
    medians = column_medians(df, columns).agg(pairs).scalar()
    return _fill_from_map(df, columns, medians)


def fill_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls by the column's mean."""
    means = df.agg(
        F.map_from_arrays(
            F.array(*[F.lit(c) for c in columns]),
            F.array(*[F.avg(number(quoted(c))) for c in columns]),
        )
    ).scalar()
    return _fill_from_map(df, columns, means)


def _fill_from_map(df: DataFrame, columns: Sequence[str], values: Column) -> DataFrame:
    filled = df.select("*", values.alias("_fill"))
    return filled.withColumns(
        {c: F.coalesce(number(quoted(c)), F.col("_fill")[c]) for c in columns}
    ).drop("_fill")


def label_codes(df: DataFrame, column: str, *, buckets: int | None = None) -> DataFrame:
    """Sorted distinct values with codes 0..k-1: ``value``, ``code``.

    The distinct values are written once and ordered in groups by the six bytes
    after the prefix that all labels share, so that they are never sorted in one task.
    """
    values = df.select(quoted(column).cast("string").alias("value")).where("value IS NOT NULL").distinct()
    values = materialise(values, "labels")
    lowest, highest = values.agg(F.min("value"), F.max("value")).first()
    if lowest is None:
        return values.select("value", F.lit(None).cast("int").alias("code"))
    shared = len(os.path.commonprefix([lowest.encode(), highest.encode()]))
    rest = F.substring(F.hex(F.encode("value", "utf-8")), 2 * shared + 1, 12)
    headed = values.withColumn("head", F.conv(F.rpad(rest, 12, "0"), 16, 10).cast("double"))
    heads = materialise(headed.groupBy("head").agg(F.count(F.lit(1)).alias("heads")), "label-heads")
    placed = running(heads, "head", {"upto": ("sum", "heads")}, buckets=buckets)
    inside = Window.partitionBy("head").orderBy("value")
    return headed.join(placed, "head").select(
        "value",
        (F.col("upto") - F.col("heads") + F.row_number().over(inside) - 1).cast("int").alias("code"),
    )


def label_encode(
    df: DataFrame, column: str, labels: Sequence[str] | None = None, codes: DataFrame | None = None
) -> DataFrame:
    """Replace a text column by the rank of its value among the sorted labels.

    Fitted ``labels`` (few) or ``codes`` (a table of any length) may be given;
    values that they lack become null.
    """
    if labels is not None:
        position = F.array_position(F.array(*[F.lit(v) for v in sorted(labels)]), quoted(column))
        return df.withColumn(column, F.nullif(position.cast("int"), F.lit(0)) - 1)
    codes = label_codes(df, column) if codes is None else codes
    coded = df.join(codes, quoted(column).cast("string") == codes["value"], "left")
    return coded.select(*[F.col("code").alias(c) if c == column else df[f"`{c}`"] for c in df.columns])


def restrict_categories(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside the list become null."""
    return df.withColumn(column, F.when(quoted(column).isin(*allowed), quoted(column)))


def one_hot(df: DataFrame, column: str, categories: Sequence[str], prefix: str) -> DataFrame:
    """Replace a column by one 0/1 column per listed category, always all of them."""
    flags = [
        F.coalesce((quoted(column) == v).cast("int"), F.lit(0)).alias(normal_name(f"{prefix}_{v}"))
        for v in categories
    ]
    return df.select(*[quoted(c) for c in df.columns if c != column], *flags)


def decode_one_hot(df: DataFrame, columns: Sequence[str], output: str, first: int = 1) -> DataFrame:
    """Add the code of a one-hot group; absent columns are skipped."""
    return df.withColumn(output, one_hot_code(columns, first, df.columns))


@dataclass
class PhenotypeFit:
    """Cohort statistics that phenotype cleaning needs again for new patients."""

    medians: dict[str, float] = field(default_factory=dict)
    gender_codes: str | None = None  # catalog table of the codes
    gender_path: str | None = None  # or, for a fit that is not stored, a path in the scratch folder

    def codes(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.gender_codes) if self.gender_codes else spark.read.parquet(self.gender_path)

    def stored(self, table: str) -> PhenotypeFit:
        """The same fit with its codes in a catalog table."""
        return PhenotypeFit(self.medians, table)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> PhenotypeFit:
        return cls(**json.loads(text))


@dataclass
class GenotypeFit:
    """SNPs that passed cohort quality control, with their mean dosage."""

    means: dict[str, float] = field(default_factory=dict)

    @property
    def snps(self) -> list[str]:
        return list(self.means)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> GenotypeFit:
        return cls(**json.loads(text))


def prepare_phenotypes(raw: DataFrame) -> DataFrame:
    """Names, required columns, duplicates and text fill: the part before fitting."""
    named = cols.normalise_names(raw)
    cols.require_columns(named, domain.REQUIRED_PHENOTYPE)
    return fill_constant(drop_duplicate_rows(named), domain.TEXT_FILL)


def fit_phenotypes(ready: DataFrame) -> PhenotypeFit:
    """Medians and gender codes of prepared phenotypes (the driver reads one row per column).

    The codes are a table of any length in the scratch folder; ``PhenotypeFit.stored`` names the
    catalog table to which a caller has copied them.
    """
    medians = {r["feature"]: r["median"] for r in column_medians(ready, domain.MEDIAN_FILL).collect()}
    path = scratch_path(ready.sparkSession, "gender-codes")
    label_codes(ready, "gender").write.parquet(path)
    return PhenotypeFit(medians, None, path)


def phenotype_violations(clean: DataFrame) -> DataFrame:
    """Clinical-range violations of cleaned phenotypes, and nulls left in integer columns."""
    return quality.range_violations(clean).unionByName(
        quality.null_violations(clean, domain.INTEGER_COLUMNS)
    )


def encode_phenotypes(ready: DataFrame, fit: PhenotypeFit | None = None) -> DataFrame:
    """Fill, encode and cast prepared phenotypes; one projection if the statistics are given."""
    if fit is None:
        filled = label_encode(fill_median(ready, domain.MEDIAN_FILL), "gender")
    else:
        filled = ready.withColumns(
            {c: F.coalesce(number(quoted(c)), F.lit(fit.medians.get(c))) for c in domain.MEDIAN_FILL}
        )
        filled = label_encode(filled, "gender", codes=fit.codes(ready.sparkSession))
    coded = one_hot(
        restrict_categories(filled, "smoking_history", domain.SMOKING_ANSWERS),
        "smoking_history",
        domain.SMOKING_ANSWERS,
        "smoking",
    )
    return cols.cast_columns(coded, domain.INTEGER_COLUMNS, domain.FLOAT_COLUMNS)


def clean_phenotypes(raw: DataFrame, fit: PhenotypeFit | None = None, *, check: bool = True) -> DataFrame:
    """Clean phenotypes: prepare, fill, encode, cast and check.

    Without ``fit`` the statistics are those of this input, which is then written
    to the scratch folder after preparation: removing duplicates moves every row,
    and the statistics and the result would each repeat it. ``check`` runs one
    counting pass and raises on a clinical-range violation.
    """
    ready = prepare_phenotypes(raw)
    if fit is None:
        ready = materialise(ready, "phenotypes")
    clean = encode_phenotypes(ready, fit)
    if check:
        quality.raise_on_violations(phenotype_violations(clean), "invalid phenotype values")
    return clean


def fit_genotypes(raw: DataFrame, key: str = domain.KEY) -> GenotypeFit:
    """Quality-control the cohort's SNP columns in one pass (reads one row per SNP).

    Raises on a dosage outside {0, 1, 2, null}.
    """
    cols.require_columns(raw, [key])
    snps = [c for c in raw.columns if c != key]
    report = quality.snp_quality(raw, snps).orderBy("position").collect()
    bad = {r["snp"]: r["invalid"] for r in report if r["invalid"]}
    if bad:
        raise ValueError(f"invalid dosages: {bad}")
    return GenotypeFit({r["snp"]: r["mean_dosage"] for r in report if r["kept"]})


def clean_genotypes(
    raw: DataFrame, fit: GenotypeFit | None = None, *, key: str = domain.KEY, check: bool = True
) -> DataFrame:
    """Key and quality-controlled SNPs, nulls filled with the cohort's mean dosage.

    Fitting checks the dosages already; with a given ``fit``, ``check`` does it.
    """
    cols.require_columns(raw, [key])
    if fit is None:
        fit = fit_genotypes(raw, key)
    elif check:
        quality.raise_on_violations(quality.dosage_violations(raw, fit.snps), "invalid dosages")
    cols.require_columns(raw, fit.snps)
    return raw.select(
        quoted(key),
        *[F.coalesce(number(quoted(c)), F.lit(m)).alias(c) for c, m in fit.means.items()],
    )
