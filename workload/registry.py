"""Query registration: a Spark function and, where SQL can say it, the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workload.tables import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, folder) -> DataFrame under a name, with its SQL."""

    def keep(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return function

    return keep


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round double columns so that both engines print the same digits."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def integers(df: DataFrame, *columns: str) -> DataFrame:
    """32-bit integers, the type both sides agree on for codes and flags."""
    return df.withColumns({c: F.col(c).cast("int") for c in columns})


def chi2_tail_sql(x: str, dof: str) -> str:
    """Chi-square tail in SQL: exact for two degrees of freedom, else the gamma series."""
    a, z = f"(({dof}) / 2.0)", f"(({x}) / 2.0)"
    series = (
        f"list_sum(list_transform(range(0, 900), lambda k: "
        f"exp(({a} + k) * ln({z}) - {z} - lgamma({a} + k + 1))))"
    )
    return (
        f"CASE WHEN ({x}) IS NULL THEN NULL WHEN ({dof}) = 2 THEN exp(-({x}) / 2) WHEN ({x}) <= 0 THEN 1.0 "
        f"WHEN ({x}) > 700 THEN 0.0 ELSE greatest(0.0, 1 - {series}) END"
    )


def t_tail_sql(t: str, v: str) -> str:
    """Two-sided Student tail in SQL by Simpson's rule over the angle atan(t / sqrt(v))."""
    start = f"atan(abs({t}) / sqrt({v}))"
    width = f"(least(pi() / 2, {start} + 40 / sqrt({v})) - {start})"
    scale = f"exp(lgamma((({v}) + 1) / 2) - lgamma(({v}) / 2)) / sqrt(pi())"
    weight = "CASE WHEN k = 0 OR k = 2000 THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END"
    area = (
        f"list_sum(list_transform(range(0, 2001), lambda k: ({weight}) * "
        f"exp((({v}) - 1) * ln(greatest(1e-300, cos({start} + k * {width} / 2000))))))"
    )
    return f"2 * ({scale}) * {width} / 6000 * {area}"
