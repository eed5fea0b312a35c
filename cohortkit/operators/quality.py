"""Filters, checks and policy rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.functions.columns import count_if, number, number_sql, quoted, registry_timestamp, text_sql
from cohortkit.operators.ordering import exact_quantiles
from cohortkit.session import broadcast_if_small


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows where all the given columns are known."""
    return df.dropna(subset=list(columns))


def in_range(column: str, low: float, high: float) -> Column:
    """Inclusive range test in which null fails."""
    return F.coalesce(quoted(column).between(low, high), F.lit(False))


def range_violations(df: DataFrame, ranges: Mapping[str, tuple[float, float]] = domain.CLINICAL_RANGES) -> DataFrame:
    """Rows outside each clinical range: ``check``, ``violations``; one pass."""
    counts = [count_if(~in_range(c, lo, hi)).alias(c) for c, (lo, hi) in ranges.items()]
    return _as_rows(df.agg(*counts), list(ranges), "check", "violations")


def dosage_violations(df: DataFrame, snps: Sequence[str]) -> DataFrame:
    """Rows with a dosage other than 0, 1, 2 or null, per SNP."""
    counts = [count_if(~number(quoted(c)).isin(*domain.DOSAGES)).alias(c) for c in snps]
    return _as_rows(df.agg(*counts), list(snps), "check", "violations")


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls in columns that must not have any, per column."""
    counts = [count_if(quoted(c).isNull()).alias(c) for c in columns]
    return _as_rows(df.agg(*counts), list(columns), "check", "violations")


def valid_dosages(df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose dosage is 0, 1 or 2."""
    return df.where(number(quoted(column)).isin(*domain.DOSAGES))


def snp_quality(df: DataFrame, snps: Sequence[str]) -> DataFrame:
    """Per SNP: missing rate, unfolded allele frequency, mean and invalid dosages, and what the filters keep.

    One aggregate over the table; the result has one row per SNP column.
    """
    measures = (
        "named_struct('position', {i}, 'snp', {c}, 'missing_rate', try_divide(count(1) - count({x}), count(1)), "
        "'mean_dosage', avg({x}), 'invalid', count_if({x} NOT IN (0D, 1D, 2D)))"
    )
    per_snp = [measures.format(i=i, c=text_sql(c), x=number_sql(c)) for i, c in enumerate(snps)]
    rows = df.selectExpr(f"array({', '.join(per_snp)}) AS _snps").select(F.inline("_snps"))
    low_missing = F.coalesce(F.col("missing_rate") <= domain.MAX_MISSING_RATE, F.lit(False))
    frequent = F.coalesce(F.col("allele_frequency") >= domain.MIN_ALLELE_FREQUENCY, F.lit(False))
    return (
        rows.withColumn("allele_frequency", F.col("mean_dosage") / 2)
        .withColumn("passes_missing", low_missing)
        .withColumn("passes_frequency", frequent)
        .withColumn("kept", F.col("passes_missing") & F.col("passes_frequency"))
    )


def duplicate_keys(df: DataFrame, key: str = domain.KEY) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_rows(df: DataFrame, what: str = "table") -> DataFrame:
    """Raise if there is no row; reads at most one."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def raise_on_violations(violations: DataFrame, what: str) -> None:
    """Raise if any check counted a violation (one row per check is read)."""
    bad = {r["check"]: r["violations"] for r in violations.where("violations > 0").collect()}
    if bad:
        raise ValueError(f"{what}: {bad}")


def storage_action(is_single_patient: Column, consent: Column) -> Column:
    """What may be done with an upload: block, store or process only."""
    consent = F.coalesce(consent, F.lit(False))
    single = F.coalesce(is_single_patient, F.lit(False))
    return F.when(consent, "store").when(single, "process_only").otherwise("block")


def with_storage_action(
    requests: DataFrame,
    single: str = "is_single_patient",
    consent: str = "consent_to_store",
    has_pheno: str | None = None,
    has_geno: str | None = None,
) -> DataFrame:
    """Add ``action``; a cohort upload that lacks one of its two files is blocked too."""
    action = storage_action(quoted(single), quoted(consent))
    for part in (has_pheno, has_geno):
        if part:
            action = F.when(~quoted(single) & ~quoted(part), "block").otherwise(action)
    return requests.withColumn("action", action)


def consent_errors(raw: Column, integrate: Column, retrain: Column) -> Column:
    """The names of all consent rules that a request breaks, as an array."""
    broken = {
        "integrate_without_raw": ~raw & integrate,
        "retrain_without_raw": ~raw & retrain,
        "integrate_without_retrain": integrate & ~retrain,
        "retrain_without_integrate": retrain & ~integrate,
    }
    return F.array_compact(
        F.array(*[F.when(test, F.lit(rule)) for rule, test in broken.items()])
    )


def date_error(column: Column) -> Column:
    """Message for a registry date that is not YYYY-MM-DD; null dates pass."""
    bad = column.isNotNull() & registry_timestamp(column).isNull()
    return F.when(bad, F.lit("registry_date must be in YYYY-MM-DD format"))


def keys_present(stored: DataFrame, batch: DataFrame, key: str = domain.KEY) -> DataFrame:
    """Keys of ``batch`` that ``stored`` holds.

    The keys of a small batch are broadcast, so a large store is filtered where it
    lies, reading the key column only.
    """
    return stored.select(key).join(broadcast_if_small(batch.select(key).distinct()), key, "left_semi").distinct()


def absent_rows(rows: DataFrame, name: str, key: str = domain.KEY) -> DataFrame:
    """Rows whose key a catalog table does not hold yet; all of them if there is no such table."""
    spark = rows.sparkSession
    if not spark.catalog.tableExists(name):
        return rows
    return rows.join(keys_present(spark.table(name), rows, key), key, "left_anti")


def already_stored(requests: DataFrame, stored: DataFrame, key: str = domain.KEY, consent: str = "consent_raw") -> DataFrame:
    """Requests rejected because raw storage already holds the patient."""
    asked = requests.where(quoted(consent))
    return asked.join(keys_present(stored, asked, key), key, "left_semi")


def not_yet_stored(requests: DataFrame, stored: DataFrame, key: str = domain.KEY, consent: str = "consent_raw") -> DataFrame:
    """Requests that go on: new patients, and those without raw-storage consent."""
    asked = requests.where(quoted(consent))
    new = asked.join(keys_present(stored, asked, key), key, "left_anti")
    return new.unionByName(requests.where(~F.coalesce(quoted(consent), F.lit(False))))


def flag_outliers(df: DataFrame, column: str, flag: str = "is_outlier") -> DataFrame:
    """Add the 1.5-IQR outlier flag; null values are not outliers."""
    quartiles = exact_quantiles(df, [column], [0.25, 0.75]).select("quantiles").scalar()
    q1, q3 = F.col("_quartiles")[0], F.col("_quartiles")[1]
    reach = (q3 - q1) * 1.5
    value = number(quoted(column))
    return (
        df.select("*", quartiles.alias("_quartiles"))
        .withColumn(flag, F.coalesce((value < q1 - reach) | (value > q3 + reach), F.lit(False)))
        .drop("_quartiles")
    )


def _as_rows(one_row: DataFrame, names: Sequence[str], name: str, value: str) -> DataFrame:
    return one_row.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias(name), quoted(c).alias(value)) for c in names]))
    )
