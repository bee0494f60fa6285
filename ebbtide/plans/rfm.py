"""RFM segmentation of the modelling set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.scalars import rfm_segment
from ebbtide.operators.histograms import value_counts
from ebbtide.operators.quantiles import rank_quintile, value_quintile
from ebbtide.params import TIER

TIES = ("member_id", TIER)


def recency_score(data: DataFrame) -> DataFrame:
    """5 = most recent."""
    score = 6 - value_quintile(data, "days_since_last_order")
    return data.withColumn("R_score", score)


def frequency_score(data: DataFrame) -> DataFrame:
    return data.withColumn("F_score", rank_quintile(data, "total_orders", TIES))


def monetary_score(data: DataFrame) -> DataFrame:
    return data.withColumn("M_score", rank_quintile(data, "total_gmv", TIES))


def rfm_scores(data: DataFrame) -> DataFrame:
    """R, F and M quintiles and their sum. Reads ``data`` several times: pass a
    stored frame."""
    scored = data.select(
        "*",
        (6 - value_quintile(data, "days_since_last_order")).alias("R_score"),
        rank_quintile(data, "total_orders", TIES).alias("F_score"),
        rank_quintile(data, "total_gmv", TIES).alias("M_score"),
    )
    return scored.withColumn(
        "RFM_score", F.col("R_score") + F.col("F_score") + F.col("M_score")
    )


def rfm_segments(data: DataFrame) -> DataFrame:
    return rfm_scores(data).withColumn("segment", rfm_segment(F.col("RFM_score")))


def segment_analysis(segmented: DataFrame) -> DataFrame:
    return segmented.where(F.col("segment").isNotNull()).groupBy("segment").agg(
        F.count("is_churned").alias("Customer_Count"),
        F.round(F.avg("is_churned"), 2).alias("Churn_Rate"),
        F.round(F.avg("total_gmv"), 2).alias("Avg_GMV"),
        F.round(F.avg("total_orders"), 2).alias("Avg_Orders"),
        F.round(F.avg("days_since_last_order"), 2).alias("Avg_Days_Since_Last"),
    )


def segment_counts(segmented: DataFrame) -> DataFrame:
    return value_counts(segmented, ["segment"])
