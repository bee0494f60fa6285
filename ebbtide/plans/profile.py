"""Exploration, data quality and headline statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.params import TIER, ChurnParams
from ebbtide.plans.labels import recent_orders
from ebbtide.sources import catalog


def summary_stats(order_header: DataFrame, params: ChurnParams) -> DataFrame:
    return recent_orders(order_header, params).agg(
        F.countDistinct("member_id").alias("unique_customers"),
        F.count("*").alias("total_orders"),
        F.avg("grand_total").alias("avg_order_value"),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
    )


def data_quality(order_header: DataFrame) -> DataFrame:
    return order_header.agg(
        F.count("*").alias("total_orders"),
        F.countDistinct("member_id").alias("unique_customers"),
        F.count(F.when(F.col("grand_total").isNull(), 1)).alias("null_amounts"),
        F.count(F.when(F.col("member_id").isNull(), 1)).alias("null_member_ids"),
        F.min("order_date").alias("earliest_date"),
        F.max("order_date").alias("latest_date"),
    )


def distinct_counts(order_header: DataFrame) -> DataFrame:
    """Distinct orders, members, outlets, months and days of the whole table."""
    return order_header.agg(
        F.countDistinct("id").alias("orders"),
        F.countDistinct("member_id").alias("members"),
        F.countDistinct("outlet_name").alias("outlets"),
        F.countDistinct(F.trunc("order_date", "month")).alias("months"),
        F.countDistinct("order_date").alias("days"),
    )


def churn_stats(labels: DataFrame, column: str = "is_churned") -> DataFrame:
    return labels.agg(
        F.count("*").alias("total_customers"),
        F.sum(F.col(column).cast("long")).alias("churned_customers"),
        F.avg(column).alias("churn_rate"),
    )


def missing_values(df: DataFrame) -> DataFrame:
    """NULL cells over all columns."""
    nulls = [F.count(F.when(F.col(c).isNull(), 1)) for c in df.columns]
    total = nulls[0]
    for more in nulls[1:]:
        total = total + more
    return df.agg(total.alias("missing_values"))


def tier_list(df: DataFrame) -> DataFrame:
    return df.select(TIER).distinct()


def explore(
    order_header: DataFrame, order_item: DataFrame, params: ChurnParams
) -> dict[str, DataFrame]:
    return {
        "order_header_structure": catalog.table_info(order_header, "order_header"),
        "order_header_row_count": catalog.row_count(order_header),
        "order_header_date_range": catalog.date_range(order_header, "order_date"),
        "order_item_structure": catalog.table_info(order_item, "order_item"),
        "order_item_row_count": catalog.row_count(order_item),
        "summary_stats": summary_stats(order_header, params),
    }
