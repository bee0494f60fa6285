"""Column expressions shared by the plans. All run inside Spark's generated code."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(as_of: dt.date, back: int = 0) -> Column:
    """``as_of`` minus ``back`` days as a DATE literal, so filters on it push down."""
    return F.lit(as_of - dt.timedelta(days=back))


def days_before(as_of: dt.date, column: str | Column) -> Column:
    return F.datediff(F.lit(as_of), column)


def weekday(column: str | Column) -> Column:
    """Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(column) - 1


def sum_when(condition: Column, value: Column) -> Column:
    """Conditional sum with 0 for every other row (NULL values are skipped)."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0.0)))


def rate(flag: Column) -> Column:
    """Share of rows whose flag is true; a NULL flag counts as false."""
    return F.avg(F.when(flag, 1.0).otherwise(0.0))


def ratio(top: Column, bottom: Column) -> Column:
    """Division giving NULL for a zero divisor."""
    return F.try_divide(top, bottom)


def recency_bucket(days: Column) -> Column:
    return (
        F.when(days <= 7, "very_recent")
        .when(days <= 30, "recent")
        .when(days <= 60, "moderate")
        .otherwise("old")
    )


RISK_BANDS = ("Low Risk", "Medium Risk", "High Risk")


def risk_segment(probability: Column) -> Column:
    """Bands [0, 0.3], (0.3, 0.7], (0.7, 1]; NULL outside."""
    return (
        F.when(probability < 0.0, None)
        .when(probability <= 0.3, "Low Risk")
        .when(probability <= 0.7, "Medium Risk")
        .when(probability <= 1.0, "High Risk")
    )


def predicted_class(probability: Column, threshold: float = 0.5) -> Column:
    return (probability >= threshold).cast("int")


def rfm_segment(score: Column) -> Column:
    return (
        F.when(score >= 13, "Champions")
        .when(score >= 11, "Loyal Customers")
        .when(score >= 9, "Potential Loyalists")
        .when(score >= 7, "At Risk")
        .when(score >= 5, "Cannot Lose Them")
        .when(score.isNotNull(), "Lost")
    )


def bucket_by_edges(value: Column, edges: Sequence[float]) -> Column:
    """1-based number of the first right-closed interval that holds ``value``.

    Equal edges need no care: the first edge at or above the value wins.
    """
    chain = F.when(value.isNull(), None)
    for number, edge in enumerate(edges[1:], start=1):
        chain = chain.when(value <= F.lit(edge), number)
    return chain


def seasonality(order_date: Column) -> dict[str, Column]:
    month = F.month(order_date)
    return {
        "month": month,
        "is_holiday_season": month.isin(11, 12).cast("int"),
    }


def double_text(value: float) -> str:
    """A number as a SQL DOUBLE literal."""
    if math.isfinite(value):
        return f"{float(value)!r}D"
    return f"double('{value}')"


def quoted(name: str) -> str:
    escaped = name.replace("`", "``")
    return f"`{escaped}`"
