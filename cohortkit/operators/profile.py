"""Dataset overview: sizes, nulls, numeric summary, dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit import domain
from cohortkit.functions.columns import count_if, number, quoted, registry_timestamp

_NUMERIC = (T.NumericType,)


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns with a number type."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def shape(df: DataFrame) -> DataFrame:
    """``n_rows``, ``n_columns`` and the column list."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
    )


def _absent(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a column of floating numbers."""
    gone = quoted(column).isNull()
    return gone | F.isnan(quoted(column)) if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)) else gone


def missing_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count per column (NaN counts as null), in one pass."""
    chosen = list(columns or df.columns)
    one_row = df.agg(*[count_if(_absent(df, c)).alias(c) for c in chosen])
    return one_row.select(
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), quoted(c).alias("missing")) for c in chosen
        ]))
    )


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 4) -> DataFrame:
    """Mean, sample deviation, min and max per numeric column, in one pass."""
    chosen = list(columns or numeric_columns(df))
    if not chosen:
        schema = "column string, mean double, std double, min double, max double"
        return df.sparkSession.createDataFrame([], schema)
    measures = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    one_row = df.agg(*[
        F.struct(*[F.round(f(number(quoted(c))), digits).alias(m) for m, f in measures.items()]).alias(c)
        for c in chosen
    ])
    rows = one_row.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).alias("s")) for c in chosen]))
    )
    return rows.select("column", "s.mean", "s.std", "s.min", "s.max")


def date_range(df: DataFrame, column: str = domain.REGISTRY_DATE) -> DataFrame:
    """First and last date; unreadable dates are ignored; null if the column is absent."""
    if column not in df.columns:
        return df.sparkSession.range(1).select(
            F.lit(None).cast("date").alias("start"), F.lit(None).cast("date").alias("end")
        )
    stored = df.schema[column].dataType
    day = registry_timestamp(quoted(column)) if isinstance(stored, T.StringType) else quoted(column)
    return df.agg(F.min(day.cast("date")).alias("start"), F.max(day.cast("date")).alias("end"))


def overview(df: DataFrame, name: str) -> DataFrame:
    """The whole dataset summary as one row, from one pass over the data."""
    chosen = numeric_columns(df)
    day = None
    if domain.REGISTRY_DATE in df.columns:
        day = registry_timestamp(quoted(domain.REGISTRY_DATE).cast("string")).cast("date")
    keys = F.array(*[F.lit(c) for c in df.columns])
    missing = F.map_from_arrays(keys, F.array(*[count_if(_absent(df, c)) for c in df.columns]))
    numbers = F.map_from_arrays(
        F.array(*[F.lit(c) for c in chosen]).cast("array<string>"),
        F.array(*[
            F.struct(
                F.round(F.avg(number(quoted(c))), 4).alias("mean"),
                F.round(F.stddev_samp(number(quoted(c))), 4).alias("std"),
                F.round(F.min(number(quoted(c))), 4).alias("min"),
                F.round(F.max(number(quoted(c))), 4).alias("max"),
            )
            for c in chosen
        ]).cast("array<struct<mean:double,std:double,min:double,max:double>>"),
    )
    dates = [F.min(day), F.max(day)] if day is not None else [F.lit(None).cast("date")] * 2
    return df.agg(
        F.lit(name).alias("dataset_name"),
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        keys.alias("columns"),
        missing.alias("missing_values"),
        numbers.alias("numeric_summary"),
        dates[0].alias("first_date"),
        dates[1].alias("last_date"),
    )
