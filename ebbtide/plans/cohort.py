"""Tier cohorts: visit and spend churn rates and mean behaviour, per tier and overall."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.scalars import day, days_before, rate, ratio
from ebbtide.params import TIER, ChurnParams

DAYS_PER_MONTH = 30.44


def periodic_spend(order_header: DataFrame, params: ChurnParams) -> DataFrame:
    """One row per (member, tier) over the whole history.

    Two distinct counts are needed, of orders and of visit days. The grouping sets
    reduce the orders to one row per day and one per order id in a single pass;
    every spend window is a function of the day, so it is summed from the day rows.
    The inner shuffle is keyed by day or id, which spreads even one dominant member.
    """
    on = F.col("order_date")
    spent = F.col("spent")
    history_cut = day(params.as_of, params.baseline_days)
    cells = (
        order_header.where(F.col(TIER).isNotNull() & F.col("member_id").isNotNull())
        .select("member_id", F.col(TIER).alias("tier"), "order_date", "id", "grand_total")
        .groupingSets(
            [
                [F.col("member_id"), F.col("tier"), F.col("order_date")],
                [F.col("member_id"), F.col("tier"), F.col("id")],
            ],
            "member_id",
            "tier",
            "order_date",
            "id",
        )
        .agg(
            F.sum("grand_total").alias("spent"),
            F.grouping("id").alias("is_day"),
        )
    )
    is_day = F.col("is_day") == 1
    dated = is_day & on.isNotNull()

    def window_sum(inside):
        # Id rows stay NULL: a window of only NULL amounts must sum to NULL, not 0.
        return F.sum(F.when(is_day, F.when(inside, spent).otherwise(0.0)))

    windows = [
        window_sum(on > day(params.as_of, n)).alias(f"spend_last_{n}_days")
        for n in params.cohort_windows
    ]
    return cells.groupBy("member_id", "tier").agg(
        F.max(F.when(is_day, on)).alias("last_order_date"),
        F.min(F.when(is_day, on)).alias("first_order_date"),
        *windows,
        window_sum(on <= history_cut).alias("historical_spend"),
        F.count(F.when(dated & (on <= history_cut), 1)).alias(
            "historical_transaction_days"
        ),
        F.count(F.when(~is_day, F.col("id"))).alias("total_orders"),
        F.sum(F.when(is_day, spent)).alias("total_gmv"),
        F.count(F.when(dated, 1)).alias("total_visits"),
    )


def cohort_flags(spend: DataFrame, params: ChurnParams) -> DataFrame:
    """Churn flags per (member, tier).

    As defined, exactly one history day gives a NULL average (and so NULL flags,
    counted as not churned); zero history days give NULL as well. With
    ``guard_zero`` only zero days do.
    """
    days = F.col("historical_transaction_days")
    blank = 0 if params.guard_zero else 1
    flagged = spend.withColumn(
        "historical_daily_avg_spend",
        ratio(F.col("historical_spend"), F.nullif(days, F.lit(blank)).cast("double")),
    )
    average = F.col("historical_daily_avg_spend")
    return flagged.select(
        "*",
        (days_before(params.as_of, F.col("last_order_date")) > params.baseline_days).alias(
            "churn_120_day_visit"
        ),
        *[
            (
                F.col(f"spend_last_{n}_days") < average * float(n) * params.threshold
            ).alias(f"churn_{n}_day_spend")
            for n in params.cohort_windows
        ],
        (F.datediff("last_order_date", "first_order_date") + 1).alias("active_days"),
    )


def _cohort_measures(params: ChurnParams):
    months = F.col("active_days") / F.lit(DAYS_PER_MONTH)
    visits = F.col("total_visits").cast("double")
    return [
        rate(F.col("churn_120_day_visit")).alias("churn_rate_120_day_visit"),
        *[
            rate(F.col(f"churn_{n}_day_spend")).alias(f"churn_rate_{n}_day_spend")
            for n in params.cohort_windows
        ],
        F.avg(ratio(F.col("total_gmv"), months)).alias("avg_monthly_spend"),
        F.avg(ratio(visits, months)).alias("avg_monthly_visits"),
        F.avg(ratio(F.col("total_orders").cast("double"), visits)).alias(
            "avg_orders_per_visit"
        ),
        F.avg(ratio(F.col("total_gmv"), visits)).alias("avg_spend_per_visit"),
    ]


def cohort_analysis(order_header: DataFrame, params: ChurnParams) -> DataFrame:
    """Tier rows and the Global row from one pass over the flags, ordered by tier."""
    flags = cohort_flags(periodic_spend(order_header, params), params)
    return (
        flags.groupingSets([[F.col("tier")], []], "tier")
        .agg(F.grouping("tier").alias("is_total"), *_cohort_measures(params))
        .withColumn("tier", F.when(F.col("is_total") == 1, "Global").otherwise(F.col("tier")))
        .drop("is_total")
        .orderBy("tier")
    )


def cohort_union(order_header: DataFrame, params: ChurnParams) -> DataFrame:
    """The same rows as a union of two aggregates; kept to check the one-pass form."""
    flags = cohort_flags(periodic_spend(order_header, params), params)
    measures = _cohort_measures(params)
    parts = [
        flags.groupBy("tier").agg(*measures),
        flags.agg(*measures).select(F.lit("Global").alias("tier"), "*"),
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("tier")
