"""The report as one long table (section, entity, metric, value)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.plans.analysis import long_form
from ebbtide.plans.profile import churn_stats
from ebbtide.plans.training import ChurnModel, feature_importance, training_metrics

TOP_FEATURES = 10


def churn_report(
    cohort: DataFrame, stats: DataFrame, model: ChurnModel, dataset: DataFrame
) -> DataFrame:
    """Cohort rates, churn statistics, model performance and top features."""
    spark = cohort.sparkSession
    shape = dataset.agg(
        F.count("*").alias("rows"), F.lit(len(dataset.columns)).alias("columns")
    )
    measures = [c for c in cohort.columns if c != "tier"]
    metrics = training_metrics(model, spark)
    best = feature_importance(model, spark, TOP_FEATURES)
    parts = [
        long_form(shape, "pipeline_summary", ["rows", "columns"]),
        long_form(cohort, "cohort_analysis", measures, F.upper("tier")),
        long_form(stats, "data_summary", stats.columns),
        long_form(
            metrics,
            "model_performance",
            ["auc", "sample_size", "churn_rate"],
            F.upper("model"),
        ),
        best.select(
            F.lit("top_features").alias("section"),
            F.upper("model").alias("entity"),
            F.col("feature").alias("metric"),
            F.col("importance").alias("value"),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def reloaded_stats(predictions: DataFrame) -> DataFrame:
    """Churn statistics from saved predictions."""
    return churn_stats(predictions, "actual_churn")
