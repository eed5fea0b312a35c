"""Cohort size, prevalence and feature trends over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit import domain
from cohortkit.functions.columns import number, quoted, registry_timestamp
from cohortkit.operators.ordering import exact_quantiles

MODES = ("year", "registry_date")


def with_time_key(df: DataFrame, mode: str = "year", date: str = domain.REGISTRY_DATE, year: str = "year") -> DataFrame:
    """Add ``time_key``: the year column if there is one, else the date's year; or the date itself."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    day = None
    if date in df.columns:
        stored = df.schema[date].dataType
        day = registry_timestamp(quoted(date)) if isinstance(stored, T.StringType) else quoted(date)
        day = day.cast("date")
    if mode == "registry_date":
        if day is None:
            raise ValueError(f"a time key by date needs {date}, which is not among {df.columns}")
        return df.withColumn("time_key", day)
    if year in df.columns:
        return df.withColumn("time_key", quoted(year).cast("int"))
    if day is None:
        raise ValueError(f"neither {year} nor {date} is there")
    return df.withColumn("time_key", F.year(day))


def time_key_summary(df: DataFrame, mode: str = "year", **names) -> DataFrame:
    """Number of distinct time keys, and whether there is only one."""
    keyed = with_time_key(df, mode, **names)
    return keyed.agg(F.count_distinct("time_key").alias("n_keys")).select(
        "n_keys", (F.col("n_keys") == 1).alias("single_key")
    )


def cohort_size(df: DataFrame, mode: str = "year", **names) -> DataFrame:
    """Patients per time key, in order of time."""
    keyed = with_time_key(df, mode, **names).where("time_key IS NOT NULL")
    return keyed.groupBy("time_key").agg(F.count(F.lit(1)).alias("n")).orderBy("time_key")


def prevalence(df: DataFrame, mode: str = "year", target: str = domain.TARGET, **names) -> DataFrame:
    """Share of the target per time key."""
    keyed = with_time_key(df, mode, **names).where("time_key IS NOT NULL")
    return keyed.groupBy("time_key").agg(F.avg(quoted(target)).alias("prevalence")).orderBy("time_key")


def feature_trend(df: DataFrame, feature: str, mode: str = "year", agg: str = "mean", **names) -> DataFrame:
    """Mean or exact median of a feature per time key."""
    if feature not in df.columns:
        raise ValueError(f"no trend of {feature}, which is not among {df.columns}")
    if agg not in ("mean", "median"):
        raise ValueError(f"agg must be mean or median, not {agg!r}")
    keyed = with_time_key(df, mode, **names).where("time_key IS NOT NULL")
    if agg == "mean":
        trend = keyed.groupBy("time_key").agg(F.avg(number(quoted(feature))).alias("value"))
    else:
        trend = exact_quantiles(keyed, [feature], [0.5], by=["time_key"]).select(
            "time_key", F.col("quantiles")[0].alias("value")
        )
    return trend.orderBy("time_key")
