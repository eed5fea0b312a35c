"""Projections: names, selections, alignment, constants and casts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.functions.columns import family, normal_name, number, quoted, registry_timestamp


def normalise_names(df: DataFrame) -> DataFrame:
    """Normalise every column name (``race:asian`` becomes ``raceasian``)."""
    return df.toDF(*[normal_name(c) for c in df.columns])


def drop_columns(df: DataFrame, names: Sequence[str] = (), prefixes: Sequence[str] = ()) -> DataFrame:
    """Drop columns by exact name or prefix; absent ones are ignored."""
    gone = [c for c in df.columns if c in names or any(c.startswith(p) for p in prefixes)]
    return df.drop(*[quoted(c) for c in gone])


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    """Raise if a column is missing; extra columns are fine."""
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def select_features(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The named features in the given order, after the ``keep`` columns."""
    require_columns(df, [*keep, *names])
    return df.select(*[quoted(c) for c in [*keep, *names]])


def select_prefix(df: DataFrame, prefix: str = domain.SNP_PREFIX, keep: Sequence[str] = ()) -> DataFrame:
    """The columns with a prefix, in table order."""
    return select_features(df, domain.snp_columns(df.columns, prefix), keep)


def align_to(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Exactly the expected columns in order; missing ones are 0; extra ones are an error."""
    extra = [c for c in df.columns if c not in expected]
    if extra:
        raise ValueError(f"unexpected columns: {extra}")
    return df.select(*[quoted(c) if c in df.columns else F.lit(0).alias(c) for c in expected])


def key_first(df: DataFrame, key: str = domain.KEY) -> DataFrame:
    """Move the key to the front."""
    return df.select(quoted(key), *[quoted(c) for c in df.columns if c != key])


def add_registry_date(df: DataFrame, date: str | Column | None) -> DataFrame:
    """Add the registry date as a constant (or from a column)."""
    value = date if isinstance(date, Column) else F.lit(date).cast("string")
    return df.withColumn(domain.REGISTRY_DATE, registry_timestamp(value).cast("date"))


def cast_columns(df: DataFrame, integers: Sequence[str], floats: Sequence[str]) -> DataFrame:
    """Truncating integer casts and single-precision casts."""
    casts = {c: quoted(c).cast("bigint" if c == domain.KEY else "int") for c in integers if c in df.columns}
    casts.update({c: quoted(c).cast("float") for c in floats if c in df.columns})
    return df.withColumns(casts)


def coerce_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Read columns as numbers; text that is no number becomes null."""
    return df.withColumns({c: number(quoted(c)) for c in columns})


def split_target(df: DataFrame, features: Sequence[str], target: str = domain.TARGET, key: str = domain.KEY) -> DataFrame:
    """Features and target of the same row, with the key; nothing is paired by position."""
    return select_features(df, [*features, target], [key])


def tag_family(df: DataFrame, feature: str = "feature") -> DataFrame:
    """Tag each feature name as genotypic or phenotypic."""
    return df.withColumn("family", family(feature))
