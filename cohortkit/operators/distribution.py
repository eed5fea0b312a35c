"""Histograms, box statistics and scatter points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.functions.columns import number, quoted
from cohortkit.operators.ordering import exact_quantiles, shuffle_token

BINS = 30
SNP_BINS = 3


def bins_for(feature: str) -> int:
    """Three bins for a dosage, thirty otherwise."""
    return SNP_BINS if feature.startswith(domain.SNP_PREFIX) else BINS


def _bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin; a value on an edge belongs to the bin on its right, the last bin is closed.

    The division may land one bin off next to an edge, so the guess is compared
    with the edges themselves.
    """
    step = (high - low) / bins
    guess = F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1))
    down = (value < low + guess * step).cast("int")
    up = ((value >= low + (guess + 1) * step) & (guess < bins - 1)).cast("int")
    return (guess - down + up).cast("int")


def histogram(df: DataFrame, column: str, bins: int | None = None) -> DataFrame:
    """``bin``, ``bin_start``, ``bin_end``, ``n`` for every bin, empty ones too."""
    return _histograms(df, column, bins or bins_for(column), None, ()).drop("class")


def class_histogram(
    df: DataFrame, column: str, target: str = domain.TARGET, classes: Sequence[int] = (0, 1), bins: int = BINS
) -> DataFrame:
    """A histogram per class, each over its own range: ``class`` and the histogram columns."""
    return _histograms(df, column, bins, target, classes)


def _histograms(df: DataFrame, column: str, bins: int, target: str | None, classes: Sequence[int]) -> DataFrame:
    value = number(quoted(column)).alias("value")
    if target is None:
        rows, classes = df.select(F.lit(0).alias("class"), value), (0,)
    else:
        rows = df.select(quoted(target).cast("int").alias("class"), value).where(F.col("class").isin(*classes))
    rows = rows.where("value IS NOT NULL")
    # One range per class: read once, as a map literal in the counting plan.
    ranges = rows.groupBy("class").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    flat = (F.col("hi") == F.col("lo")).cast("double") * 0.5  # a constant column gets a range of width 1
    span = F.struct((F.col("lo") - flat).alias("lo"), (F.col("hi") + flat).alias("hi"))
    spans = ranges.agg(F.map_from_entries(F.collect_list(F.struct("class", span.alias("span"))))).scalar()
    counts = (
        rows.select("class", "value", spans.alias("_spans"))
        .withColumn("_span", F.col("_spans")[F.col("class")])
        .select("class", _bin_of(F.col("value"), F.col("_span.lo"), F.col("_span.hi"), bins).alias("bin"))
        .groupBy("class", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # The bins come from the same ranges, which Spark computes once.
    grid = (
        df.sparkSession.range(1)
        .select(F.explode(spans).alias("class", "_span"))
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .withColumn("_step", (F.col("_span.hi") - F.col("_span.lo")) / bins)
    )
    # Both sides are at most classes x bins rows.
    return grid.join(F.broadcast(counts), ["class", "bin"], "left").select(
        "class",
        "bin",
        (F.col("_span.lo") + F.col("bin") * F.col("_step")).alias("bin_start"),
        F.when(F.col("bin") == bins - 1, F.col("_span.hi"))
        .otherwise(F.col("_span.lo") + (F.col("bin") + 1) * F.col("_step"))
        .alias("bin_end"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def box_statistics(
    df: DataFrame,
    column: str,
    target: str | None = None,
    classes: Sequence[int] = (0, 1),
) -> DataFrame:
    """Quartiles, whiskers (furthest points within 1.5 IQR) and outlier count, whole or per class of ``classes``."""
    value = number(quoted(column)).alias("value")
    if target is None:
        rows = df.select(F.lit(0).alias("class"), value)
    else:
        rows = df.select(quoted(target).cast("int").alias("class"), value).where(F.col("class").isin(*classes))
    quartiles = (
        exact_quantiles(rows, ["value"], [0.25, 0.5, 0.75], by=["class"])
        .agg(F.map_from_entries(F.collect_list(F.struct("class", "quantiles"))))  # one entry per class
        .scalar()
    )
    q1, q3 = F.col("_q")[0], F.col("_q")[2]
    reach = (q3 - q1) * 1.5
    inside = F.col("value").between(q1 - reach, q3 + reach)
    stats = (
        rows.where("value IS NOT NULL")
        .select("class", "value", quartiles.alias("_all"))
        .select("class", "value", F.col("_all")[F.col("class")].alias("_q"))
        .groupBy("class", "_q")
        .agg(
            F.count("value").alias("n"),
            F.min(F.when(inside, F.col("value"))).alias("_low"),
            F.max(F.when(inside, F.col("value"))).alias("_high"),
            F.count(F.when(~inside, 1)).alias("n_outliers"),
        )
        .select(
            "class",
            "n",
            q1.alias("q1"),
            F.col("_q")[1].alias("median"),
            q3.alias("q3"),
            F.least(q1, "_low").alias("whisker_low"),
            F.greatest(q3, "_high").alias("whisker_high"),
            "n_outliers",
        )
    )
    return stats.drop("class") if target is None else stats


def scatter_points(
    df: DataFrame, column: str, target: str = domain.TARGET, key: str = domain.KEY, seed: int = 42, jitter: float = 0.05,
    token: Column | None = None,
) -> DataFrame:
    """Per row: the target moved by a jitter, and the feature value.

    The jitter is a hash of the key, of the whole row if there is no key (or ``token``,
    a number in [0, 2^31)), so a row gets the same point however the table is partitioned.
    """
    if token is None:
        whole = F.shiftrightunsigned(F.xxhash64(*[quoted(c) for c in df.columns], F.lit(seed)), 33)
        token = shuffle_token(key, seed) if key in df.columns else whole
    share = token.cast("double") / (1 << 31)
    known = df.select(quoted(target).cast("double").alias("class"), number(quoted(column)).alias("y"), share.alias("_share")).dropna()
    return known.select((F.col("class") + F.col("_share") * (2 * jitter) - jitter).alias("x"), "y")
