"""Counts of a category against the target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.functions.columns import count_if, one_hot_code, quoted


def grouped_counts(
    df: DataFrame, feature: str, target: str = domain.TARGET, classes: Sequence[int] = (0, 1)
) -> DataFrame:
    """Rows per level of a feature, one column per class (``class_0``, ``class_1``)."""
    known = df.where(quoted(feature).isNotNull() & quoted(target).isNotNull())
    return known.groupBy(quoted(feature).alias("level")).agg(
        *[count_if(quoted(target) == c).alias(f"class_{c}") for c in classes]
    )


def encoded_counts(
    df: DataFrame, labels: Mapping[str, str], target: str = domain.TARGET, classes: Sequence[int] = (0, 1)
) -> DataFrame:
    """Grouped counts of a one-hot group, with code (from 1) and label."""
    coded = df.select(one_hot_code(list(labels), 1, df.columns).alias("code"), quoted(target))
    counts = grouped_counts(coded, "code", target, classes).withColumnRenamed("level", "code")
    names = F.array(*[F.lit(v) for v in labels.values()])
    return counts.select("code", F.get(names, F.col("code") - 1).alias("label"), *[f"class_{c}" for c in classes])


def contingency(df: DataFrame, left: str, right: str) -> DataFrame:
    """Counts of each observed pair of levels: ``left``, ``right``, ``n``; pairs with a null are dropped."""
    pairs = df.select(quoted(left).alias("left"), quoted(right).alias("right")).dropna()
    return pairs.groupBy("left", "right").agg(F.count(F.lit(1)).alias("n"))
