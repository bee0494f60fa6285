"""Tables behind the churn, segment, risk and dashboard views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.scalars import RISK_BANDS
from ebbtide.operators import evaluation
from ebbtide.operators.histograms import grid_counts, histogram, value_counts
from ebbtide.params import TIER

LABEL = "is_churned"


def churn_counts(data: DataFrame) -> DataFrame:
    """Rows per label value; each row names its own class."""
    return value_counts(data, [LABEL])


def churn_by(data: DataFrame, column: str) -> DataFrame:
    """Rows and churn rate per value of a column; NULL values form no group."""
    return (
        data.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(LABEL).alias("count"), F.avg(LABEL).alias("churn_rate"))
    )


def churn_by_recency(data: DataFrame) -> DataFrame:
    return churn_by(data, "recency_bucket")


def churn_by_tier(data: DataFrame) -> DataFrame:
    return churn_by(data, TIER)


def recency_histogram(data: DataFrame) -> DataFrame:
    return histogram(data, F.col("days_since_last_order"), LABEL)


def aov_log_histogram(data: DataFrame) -> DataFrame:
    return histogram(data, F.log1p("avg_order_value"), LABEL)


def gmv_histogram(data: DataFrame) -> DataFrame:
    return histogram(data, F.col("total_gmv"))


def probability_histogram(predictions: DataFrame) -> DataFrame:
    return histogram(predictions, F.col("churn_probability"), "actual_churn")


def frequency_monetary_grid(data: DataFrame) -> DataFrame:
    return grid_counts(data, "total_orders", "total_gmv", LABEL)


def frequency_recency_grid(data: DataFrame) -> DataFrame:
    return grid_counts(data, "total_orders", "days_since_last_order", LABEL)


def risk_segment_performance(predictions: DataFrame, all_bands: bool = False) -> DataFrame:
    """Rows, churn rate and mean probability per risk band; with ``all_bands`` also the
    bands without rows, with count 0 and NULL figures."""
    found = (
        predictions.where(F.col("risk_segment").isNotNull())
        .groupBy("risk_segment")
        .agg(
            F.count("actual_churn").alias("Count"),
            F.round(F.avg("actual_churn"), 3).alias("Actual_Churn_Rate"),
            F.round(F.avg("churn_probability"), 3).alias("Avg_Probability"),
        )
    )
    if not all_bands:
        return found
    bands = predictions.sparkSession.range(len(RISK_BANDS)).select(
        F.get(F.array(*map(F.lit, RISK_BANDS)), F.col("id").cast("int")).alias("risk_segment")
    )
    return bands.join(found, "risk_segment", "left").withColumn(
        "Count", F.coalesce("Count", F.lit(0).cast("long"))
    )


def dashboard_join(data: DataFrame, predictions: DataFrame) -> DataFrame:
    """The analysis data with probability and risk band.

    Joins on member and tier when the predictions carry the tier, so that a member
    with several tiers gets each prediction once; else on the member alone.
    """
    keys = [c for c in ("member_id", TIER) if c in predictions.columns and c in data.columns]
    right = predictions.select(
        *[F.col(k).alias(f"_{k}") for k in keys], "churn_probability", "risk_segment"
    )
    match = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    )
    return data.join(right, match, "left").drop(*[f"_{k}" for k in keys])


def segment_churn(segmented: DataFrame) -> DataFrame:
    return (
        segmented.where(F.col("segment").isNotNull())
        .groupBy("segment")
        .agg(F.avg(LABEL).alias("churn_rate"))
    )


def risk_counts(data: DataFrame) -> DataFrame:
    return value_counts(data, ["risk_segment"])


def long_form(
    row: DataFrame, section: str, metrics: list[str], entity: Column | None = None
) -> DataFrame:
    """Turn one column per metric into rows (section, entity, metric, value)."""
    name = F.lit(None).cast("string") if entity is None else entity
    return row.select(
        F.lit(section).alias("section"),
        name.alias("entity"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")
                    )
                    for m in metrics
                ]
            )
        ),
    )


def insights(
    data: DataFrame, predictions: DataFrame | None = None, inactive_days: int = 60
) -> DataFrame:
    """Key figures as rows (section, entity, metric, value); a section appears when
    its columns are present."""
    have = set(data.columns)
    idle = (
        F.col("days_since_last_order") > inactive_days
        if "days_since_last_order" in have
        else F.lit(None).cast("boolean")
    )
    figures = {"total_customers": F.count("*"), "churn_rate": F.avg(LABEL)}
    if "total_gmv" in have:
        figures["avg_gmv"] = F.avg("total_gmv")
    if "total_orders" in have:
        figures["avg_orders"] = F.avg("total_orders")
    idle_figures = {
        "customers_inactive_60_days": F.count(F.when(idle, 1)),
        "churn_rate_inactive_customers": F.avg(F.when(idle, F.col(LABEL))),
    }
    totals = data.agg(*[c.alias(n) for n, c in {**figures, **idle_figures}.items()])
    sections = [("basic_stats", list(figures))]
    if "days_since_last_order" in have:
        sections.append(("risk_factors", list(idle_figures)))
    # Both sections come from one aggregate over the data.
    parts = [
        totals.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(section).alias("section"),
                            F.lit(None).cast("string").alias("entity"),
                            F.lit(m).alias("metric"),
                            F.col(m).cast("double").alias("value"),
                        )
                        for section, metrics in sections
                        for m in metrics
                    ]
                )
            )
        )
    ]
    if "segment" in have:
        measures = {"count": F.count(LABEL), "churn_rate": F.round(F.avg(LABEL), 3)}
        if "total_gmv" in have:
            measures["avg_gmv"] = F.round(F.avg("total_gmv"), 3)
        per_segment = (
            data.where(F.col("segment").isNotNull())
            .groupBy("segment")
            .agg(*[c.alias(n) for n, c in measures.items()])
        )
        parts.append(
            long_form(per_segment, "segment_analysis", list(measures), F.col("segment"))
        )
    if predictions is not None and "churn_probability" in predictions.columns:
        auc = evaluation.roc_auc(predictions).withColumnRenamed("auc", "auc_score")
        parts.append(long_form(auc, "model_performance", ["auc_score"]))
        parts.append(
            long_form(
                evaluation.precision_recall(predictions),
                "model_performance",
                ["precision", "recall"],
            )
        )
    return reduce(DataFrame.unionByName, parts)
