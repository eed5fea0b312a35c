"""Feature catalogue and the routing of a feature to its analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.operators.crosstab import encoded_counts, grouped_counts
from cohortkit.operators.distribution import box_statistics, class_histogram, histogram, scatter_points
from cohortkit.operators.quality import flag_outliers

ENCODED = {"race (encoded)": domain.RACE_LABELS, "smoking (encoded)": domain.SMOKING_LABELS}

#: Columns that name or place a patient; the year can still be set against the target.
NOT_RELATED = {domain.KEY, domain.REGISTRY_DATE, "location"}
#: Stands for every plot of a kind that has only one analysis.
ANY_PLOT = "*"
#: What a feature's kind and the plot call for.
RELATIONSHIPS = {
    "numeric": {"hist": class_histogram, "box": box_statistics, "scatter": scatter_points},
    "binary": {ANY_PLOT: grouped_counts},
    "snp": {ANY_PLOT: grouped_counts},
    "encoded": {ANY_PLOT: lambda df, feature, target: encoded_counts(df, ENCODED[feature], target)},
}


def feature_names(columns: list[str], mode: str = "distribution") -> list[str]:
    """Features on offer, sorted; relationship mode folds complete one-hot groups into one name."""
    names = set(columns) - set(domain.NOT_A_FEATURE)
    if mode == "relationship":
        folded = {n for n, labels in ENCODED.items() if set(labels) <= names}
        names = {n for n in names if not n.startswith(("race", "smoking_"))} | folded
    elif mode != "distribution":
        raise ValueError(f"unknown mode {mode!r}")
    return sorted(names)


def feature_catalogue(df: DataFrame, mode: str = "distribution") -> DataFrame:
    """The same as a table: ``feature``, ``kind``. Reads no data."""
    rows = [(n, feature_kind(n)) for n in feature_names(df.columns, mode)]
    return df.sparkSession.createDataFrame(rows, "feature string, kind string")


def feature_kind(feature: str) -> str:
    """encoded, snp, binary or numeric."""
    if feature in ENCODED:
        return "encoded"
    if feature.startswith(domain.SNP_PREFIX):
        return "snp"
    return "binary" if feature in domain.BINARY_COLUMNS else "numeric"


def relationship(df: DataFrame, feature: str, plot: str = "hist", target: str = domain.TARGET) -> DataFrame:
    """The numbers behind a feature-against-target plot, by ``RELATIONSHIPS``."""
    routes = RELATIONSHIPS[feature_kind(feature)]
    analyse = routes.get(plot, routes.get(ANY_PLOT))
    if analyse is None:
        raise ValueError(f"{plot!r} is no plot of {feature} against {target}; there are {sorted(routes)}")
    reads = set(ENCODED.get(feature, [feature]))
    if reads & NOT_RELATED or not reads & set(df.columns):
        raise ValueError(f"{feature} is none of the features: {feature_names(df.columns, 'relationship')}")
    return analyse(df, feature, target)


def distribution(df: DataFrame, feature: str, plot: str = "hist", highlight_outliers: bool = False) -> DataFrame:
    """The numbers behind a one-feature plot; highlighting returns the outlying values instead."""
    if plot not in ("hist", "box"):
        raise ValueError(f"{plot!r} is no plot of one feature; there are box and hist")
    if feature not in df.columns:
        raise ValueError(f"{feature} is none of the columns: {df.columns}")
    if plot == "hist":
        return histogram(df, feature)
    if highlight_outliers:
        return flag_outliers(df, feature).where("is_outlier").select(F.col(f"`{feature}`").alias("value"))
    return box_statistics(df, feature)
