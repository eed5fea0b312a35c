"""Classification metrics and curves over keyed predictions.

Predictions have ``y_true`` (0/1), ``y_prob`` and, once classified, ``y_pred``.
Curves first count rows per distinct score, so ties are exact and nothing is
sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.functions.columns import count_if
from cohortkit.operators.ordering import running
from cohortkit.session import materialise


def classify(df: DataFrame, threshold: float = domain.DECISION_THRESHOLD) -> DataFrame:
    """Add ``y_pred``: 1 where the probability reaches the threshold."""
    return df.withColumn("y_pred", (F.col("y_prob") >= threshold).cast("int"))


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """``y_true``, ``y_pred``, ``n`` for all four cells."""
    cells = [(t, p) for t in (0, 1) for p in (0, 1)]
    one_row = predictions.agg(F.array(*[
        F.struct(
            F.lit(t).alias("y_true"),
            F.lit(p).alias("y_pred"),
            count_if((F.col("y_true") == t) & (F.col("y_pred") == p)).alias("n"),
        )
        for t, p in cells
    ]).alias("_cells"))
    return one_row.select(F.inline("_cells"))


def score_counts(predictions: DataFrame) -> DataFrame:
    """Positives and negatives per distinct score."""
    return predictions.groupBy(F.col("y_prob").alias("score")).agg(
        count_if(F.col("y_true") == 1).alias("pos"), count_if(F.col("y_true") == 0).alias("neg")
    )


def _cumulative(predictions: DataFrame) -> DataFrame:
    # The running totals read the counts several times; the predictions are read once.
    counts = materialise(score_counts(predictions), "score-counts")
    totals = counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    return running(
        counts, "score", {"tp": ("sum", "pos"), "fp": ("sum", "neg")}, descending=True
    ).select("*", totals.alias("_totals"))


def roc_curve(predictions: DataFrame) -> DataFrame:
    """One point per distinct score, from the origin: ``threshold``, ``fpr``, ``tpr``."""
    points = _cumulative(predictions).select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp"), F.col("_totals.n")).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("_totals.p")).alias("tpr"),
    )
    origin = predictions.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def roc_auc(predictions: DataFrame) -> DataFrame:
    """Area under the ROC curve by trapezoids, one row ``roc_auc``; null without both classes."""
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    cumulative = _cumulative(predictions)
    return cumulative.agg(
        F.try_divide(area, F.max("_totals.p").cast("double") * F.max("_totals.n")).alias("roc_auc")
    )


def pr_curve(predictions: DataFrame) -> DataFrame:
    """One point per distinct score plus the end point (recall 0, precision 1)."""
    points = _cumulative(predictions).select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("tp"), F.col("_totals.p")).alias("recall"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
    )
    end = predictions.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision")
    )
    return points.unionByName(end)


def classification_metrics(predictions: DataFrame, threshold: float = domain.DECISION_THRESHOLD) -> DataFrame:
    """Accuracy, precision, recall, F1 (0 where undefined) and AUC as one row."""
    hit = {(t, p): count_if((F.col("y_true") == t) & (F.col("y_pred") == p)) for t in (0, 1) for p in (0, 1)}
    counted = predictions.agg(
        hit[1, 1].alias("tp"), hit[0, 1].alias("fp"), hit[1, 0].alias("fn"), hit[0, 0].alias("tn")
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def ratio(top, bottom):
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    return counted.select(
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        roc_auc(predictions).scalar().alias("roc_auc"),
        F.lit(float(threshold)).alias("threshold"),
    )
