"""Ranking and classification quality as DataFrame aggregates.

Every curve starts from one row per distinct score, so ties are exact and the
ordered part is as small as the number of distinct scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.scalars import predicted_class, ratio
from ebbtide.operators.ordering import with_running_sums

ACTUAL = "actual_churn"
SCORE = "churn_probability"


def score_steps(predictions: DataFrame, actual: str = ACTUAL, score: str = SCORE) -> DataFrame:
    """Per distinct score, highest first: hits and misses at it and up to it."""
    per_score = (
        predictions.where(F.col(score).isNotNull() & F.col(actual).isNotNull())
        .groupBy(F.col(score).alias("threshold"))
        .agg(
            F.sum(F.col(actual).cast("long")).alias("pos"),
            F.sum(1 - F.col(actual).cast("long")).alias("neg"),
        )
    )
    return with_running_sums(per_score, [F.desc("threshold")], ["pos", "neg"])


def _share(top: str, bottom: str):
    return ratio(F.col(top).cast("double"), F.col(bottom).cast("double"))


def roc_curve(predictions: DataFrame, actual: str = ACTUAL, score: str = SCORE) -> DataFrame:
    """All thresholds, plus the start point (0, 0) with a NULL threshold."""
    steps = score_steps(predictions, actual, score).select(
        "threshold",
        _share("cum_neg", "all_neg").alias("fpr"),
        _share("cum_pos", "all_pos").alias("tpr"),
    )
    start = predictions.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return start.unionByName(steps)


def pr_curve(predictions: DataFrame, actual: str = ACTUAL, score: str = SCORE) -> DataFrame:
    """All thresholds, plus the end point (recall 0, precision 1) with a NULL threshold."""
    steps = score_steps(predictions, actual, score).select(
        "threshold",
        ratio(
            F.col("cum_pos").cast("double"),
            (F.col("cum_pos") + F.col("cum_neg")).cast("double"),
        ).alias("precision"),
        _share("cum_pos", "all_pos").alias("recall"),
    )
    end = predictions.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return steps.unionByName(end)


def roc_auc(predictions: DataFrame, actual: str = ACTUAL, score: str = SCORE) -> DataFrame:
    """Share of (positive, negative) pairs ranked right, a tie counting one half."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    below = (F.col("all_neg") - F.col("cum_neg")).cast("double")
    return score_steps(predictions, actual, score).agg(
        ratio(
            F.sum(pos * (below + neg / 2.0)),
            F.max(F.col("all_pos").cast("double") * F.col("all_neg").cast("double")),
        ).alias("auc")
    )


def average_precision(
    predictions: DataFrame, actual: str = ACTUAL, score: str = SCORE
) -> DataFrame:
    """Sum of recall steps times precision."""
    gained = _share("pos", "all_pos")
    precision = F.col("cum_pos").cast("double") / (F.col("cum_pos") + F.col("cum_neg"))
    return score_steps(predictions, actual, score).agg(
        F.sum(gained * precision).alias("average_precision")
    )


def confusion_matrix(
    predictions: DataFrame, actual: str = ACTUAL, predicted: str = "predicted_churn"
) -> DataFrame:
    """Four rows (actual, predicted, n), also for combinations that do not occur."""
    cells = [(a, p) for a in (0, 1) for p in (0, 1)]
    row = predictions.agg(
        *[
            F.count(F.when((F.col(actual) == a) & (F.col(predicted) == p), 1)).alias(f"n{a}{p}")
            for a, p in cells
        ]
    )
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("actual"),
                        F.lit(p).alias("predicted"),
                        F.col(f"n{a}{p}").alias("n"),
                    )
                    for a, p in cells
                ]
            )
        )
    )


def precision_recall(
    predictions: DataFrame, actual: str = ACTUAL, score: str = SCORE, threshold: float = 0.5
) -> DataFrame:
    """Precision and recall at a threshold; 0 where the denominator is 0."""
    hit = predicted_class(F.col(score), threshold) == 1
    true = F.col(actual) == 1
    both = F.count(F.when(hit & true, 1)).cast("double")
    return predictions.agg(
        F.coalesce(ratio(both, F.count(F.when(hit, 1)).cast("double")), F.lit(0.0)).alias(
            "precision"
        ),
        F.coalesce(ratio(both, F.count(F.when(true, 1)).cast("double")), F.lit(0.0)).alias(
            "recall"
        ),
    )
