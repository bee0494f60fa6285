"""Churn labels: one row per member with enough orders in the history window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.scalars import day, sum_when
from ebbtide.params import ChurnParams


def recent_orders(order_header: DataFrame, params: ChurnParams) -> DataFrame:
    """Orders of the history window. There is no upper bound: an order dated after
    ``as_of`` counts as recent."""
    return order_header.where(
        F.col("order_date") >= day(params.as_of, params.history_days)
    )


def member_spend(order_header: DataFrame, params: ChurnParams) -> DataFrame:
    """Spend of the current and previous period and the historical baseline.

    One grouped aggregate over one scan: all three windows are conditional
    aggregates, so rows are combined before the shuffle and a very frequent member
    costs no more than one row per task.
    """
    on = F.col("order_date")
    paid = F.col("grand_total")
    current = day(params.as_of, params.current_days)
    previous = day(params.as_of, params.current_days + params.previous_days)
    baseline = day(params.as_of, params.baseline_days)
    return (
        recent_orders(order_header, params)
        .groupBy("member_id")
        .agg(
            F.count("*").alias("orders"),
            sum_when(on >= current, paid).alias("spend_last_60_days"),
            sum_when((on >= previous) & (on < current), paid).alias(
                "spend_previous_60_days"
            ),
            (F.avg(F.when(on < baseline, paid)) * 2).alias("historical_60day_baseline"),
        )
        .where(F.col("orders") >= params.min_orders)
        .drop("orders")
    )


def churn_labels(order_header: DataFrame, params: ChurnParams) -> DataFrame:
    spend = F.col("spend_last_60_days")

    def dropped(base: str):
        # A NULL base makes the test NULL, which the CASE reads as "not churned".
        return (F.col(base) > 0) & (spend <= F.col(base) * params.threshold)

    by_previous = dropped("spend_previous_60_days")
    by_baseline = dropped("historical_60day_baseline")
    return member_spend(order_header, params).select(
        "*",
        F.when(by_previous, 1).otherwise(0).alias("churned_vs_previous"),
        F.when(by_baseline, 1).otherwise(0).alias("churned_vs_baseline"),
        F.when(by_previous | by_baseline, 1).otherwise(0).alias("is_churned"),
    )
