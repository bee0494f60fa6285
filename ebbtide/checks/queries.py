"""The registered queries: each runs one operator over the whole sample tables.

Floating-point results are rounded so that they can be compared with SQL.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions import scalars
from ebbtide.operators import correlation, evaluation
from ebbtide.operators.ordering import forward_filled
from ebbtide.operators.quantiles import exact_quantiles
from ebbtide.params import TIER, ChurnParams, ModelParams
from ebbtide.plans import (
    analysis,
    cohort,
    features,
    labels,
    prepare,
    profile,
    report,
    rfm,
    scoring,
    training,
)
from ebbtide.plans.run import modelling_set, run
from ebbtide.session import shared_folder, stored
from ebbtide.sources import catalog, sinks
from ebbtide.sources.schemas import ORDER_ITEM, PREDICTIONS
from ebbtide.sources.tables import (
    Tables,
    read_csv,
    sample_header,
    sample_item,
    sample_tables,
)

PARAMS = ChurnParams(as_of=dt.date(2001, 8, 1))
CUSTOM = dataclasses.replace(
    PARAMS, threshold=0.3, current_days=90, previous_days=90, baseline_days=180
)
MODEL = ModelParams()

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Quotients by 8, 16 or 32 end in a 5; these digits keep clear of it.
FINER = {
    "avg_order_value": 6,
    "weekend_avg_spend": 6,
    "weekday_avg_spend": 6,
    "avg_days_between_orders": 6,
    "avg_day_of_week": 6,
    "avg_quantity_per_item": 6,
    "historical_60day_baseline": 6,
    "historical_daily_avg_spend": 6,
    "rf_interaction": 8,
}
# Values up to 1e12 have few decimals left in a double.
COARSER = {
    "vvip_service_expectation": 3,
    "gold_spending_stability": 3,
    "silver_engagement_trend": 3,
    "fm_interaction": 2,
    "rfm_composite": 0,
}


def rounded(df: DataFrame, digits: int = 4, **special: int) -> DataFrame:
    """Round every double column; ``special`` gives other digits for single columns."""
    special = FINER | COARSER | special
    return df.select(
        *[
            F.round(F.col(f.name), special.get(f.name, digits)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return sample_tables(spark, sf_dir)


def header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_header(spark, sf_dir)


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/ebbtide-{uuid.uuid4().hex}"


@functools.lru_cache(maxsize=8)
def _stored_dataset(app: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(modelling_set(tables(spark, sf_dir), PARAMS))


def dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modelling set, written once per application and read by later queries."""
    return _stored_dataset(spark.sparkContext.applicationId, spark, sf_dir)


@functools.lru_cache(maxsize=8)
def _stored_features(app: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return stored(features.feature_set(t.order_header, t.order_item, PARAMS))


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All feature rows, labelled or not: members with few orders have gaps there."""
    return _stored_features(spark.sparkContext.applicationId, spark, sf_dir)


@functools.lru_cache(maxsize=4)
def _fitted(app: str, spark: SparkSession, sf_dir: str) -> training.ChurnModel:
    return training.train_models(dataset(spark, sf_dir), MODEL)


def fitted(spark: SparkSession, sf_dir: str) -> training.ChurnModel:
    return _fitted(spark.sparkContext.applicationId, spark, sf_dir)


def closed_score(data: DataFrame) -> DataFrame:
    """Predictions from a closed formula of recency, for exact checks."""
    score = F.greatest(
        F.lit(0.0), F.least(F.lit(1.0), F.col("days_since_last_order") / F.lit(365.0))
    )
    return data.select(
        "member_id",
        TIER,
        F.col("is_churned").alias("actual_churn"),
        scalars.predicted_class(score).alias("predicted_churn"),
        score.alias("churn_probability"),
        scalars.risk_segment(score).alias("risk_segment"),
    )


# --- sources and sinks -------------------------------------------------------------


@query
def scan_order_header(spark, sf_dir):
    return header(spark, sf_dir)


@query
def scan_order_item(spark, sf_dir):
    return sample_item(spark, sf_dir)


@query
def sql_passthrough(spark, sf_dir):
    tables(spark, sf_dir).as_views()
    return catalog.run_sql(
        spark,
        """
        SELECT outlet_name, COUNT(*) AS orders, ROUND(SUM(grand_total), 2) AS gmv
        FROM order_header
        WHERE order_date >= :start AND member_tier_when_transact = :tier
        GROUP BY outlet_name
        """,
        {"start": dt.date(2000, 1, 1), "tier": "GOLD"},
    )


@query
def table_info(spark, sf_dir):
    t = tables(spark, sf_dir)
    return catalog.table_info(t.order_header, "order_header").unionByName(
        catalog.table_info(t.order_item, "order_item")
    )


@query
def table_row_count(spark, sf_dir):
    t = tables(spark, sf_dir)
    parts = [
        catalog.row_count(df).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in (("order_header", t.order_header), ("order_item", t.order_item))
    ]
    return parts[0].unionByName(parts[1])


@query
def date_range(spark, sf_dir):
    return catalog.date_range(header(spark, sf_dir), "order_date")


@query
def csv_roundtrip(spark, sf_dir):
    path = sinks.stamped(_scratch(spark), "churn_predictions")
    sinks.write_csv(closed_score(dataset(spark, sf_dir)), path)
    return rounded(read_csv(spark, path, PREDICTIONS), 6)


@query
def append_order_items(spark, sf_dir):
    """A cover sheet that is left out, the items in two halves, and between them an input
    without the right columns, which is skipped."""
    base = _scratch(spark)
    items = sample_item(spark, sf_dir)
    late = F.coalesce(F.col("quantity") >= 25, F.lit(False))
    catalog.row_count(items).write.parquet(f"{base}/cover")
    items.where(late).write.parquet(f"{base}/part1")
    items.where(~late).write.parquet(f"{base}/part2")
    target = f"{base}/order_item"
    sinks.append_inputs(
        spark,
        [f"{base}/cover", f"{base}/part1", f"{base}/cover", f"{base}/part2"],
        target,
        ORDER_ITEM,
    )
    appended = spark.read.schema(ORDER_ITEM).parquet(target)
    return appended.groupBy("brand_name").agg(
        F.count("*").alias("n_lines"), F.sum("quantity").alias("sum_quantity")
    )


@query
def reload_churn_stats(spark, sf_dir):
    path = sinks.stamped(_scratch(spark), "churn_predictions")
    sinks.write_csv(closed_score(dataset(spark, sf_dir)), path)
    return rounded(report.reloaded_stats(read_csv(spark, path, PREDICTIONS)), 6)


# --- labels and cohorts --------------------------------------------------------------


@query
def history_window(spark, sf_dir):
    return labels.recent_orders(header(spark, sf_dir), PARAMS).select(
        "id", "member_id", "order_date", "grand_total"
    )


@query
def churn_labels_custom(spark, sf_dir):
    """Two periods of 90 days and a threshold of 0.3."""
    return rounded(labels.churn_labels(header(spark, sf_dir), CUSTOM), 2)


@query
def churn_labels(spark, sf_dir):
    return rounded(labels.churn_labels(header(spark, sf_dir), PARAMS), 2)


@query
def spend_windows(spark, sf_dir):
    return rounded(labels.member_spend(header(spark, sf_dir), PARAMS), 2)


@query
def churn_stats(spark, sf_dir):
    found = labels.churn_labels(header(spark, sf_dir), PARAMS)
    return rounded(profile.churn_stats(found), 6)


@query
def customer_periodic_spend(spark, sf_dir):
    return rounded(cohort.periodic_spend(header(spark, sf_dir), PARAMS), 2)


@query
def cohort_flags(spark, sf_dir):
    spend = cohort.periodic_spend(header(spark, sf_dir), PARAMS)
    return rounded(cohort.cohort_flags(spend, PARAMS), 2)


@query
def cohort_analysis(spark, sf_dir):
    return rounded(cohort.cohort_analysis(header(spark, sf_dir), PARAMS))


@query
def cohort_union(spark, sf_dir):
    return rounded(cohort.cohort_union(header(spark, sf_dir), PARAMS))


# --- features --------------------------------------------------------------------------


@query
def base_features(spark, sf_dir):
    return rounded(features.base_features(header(spark, sf_dir), PARAMS))


@query
def product_features(spark, sf_dir):
    t = tables(spark, sf_dir)
    return rounded(features.product_features(t.order_header, t.order_item, PARAMS), 6)


@query
def days_between_orders_repeats(spark, sf_dir):
    """Orders repeated once per line of theirs: repeated rows are 0 days apart."""
    t = tables(spark, sf_dir)
    lines = t.order_item.select("order_number")
    return features.days_between_orders(t.order_header.join(lines, "order_number"), PARAMS)


@query
def behavioral_features(spark, sf_dir):
    return rounded(features.behavioral_features(header(spark, sf_dir), PARAMS))


@query
def feature_set(spark, sf_dir):
    t = tables(spark, sf_dir)
    return rounded(features.feature_set(t.order_header, t.order_item, PARAMS))


@query
def final_dataset(spark, sf_dir):
    return rounded(modelling_set(tables(spark, sf_dir), PARAMS))


@query
def order_value_stats(spark, sf_dir):
    return rounded(features.order_value_stats(header(spark, sf_dir), PARAMS))


@query
def primary_outlet(spark, sf_dir):
    return features.primary_outlet(header(spark, sf_dir), PARAMS)


@query
def favorite_day_of_week(spark, sf_dir):
    found = features.behavioral_features(header(spark, sf_dir), PARAMS)
    return rounded(found.select("member_id", "favorite_day_of_week", "avg_day_of_week"))


@query
def weekend_weekday_spend(spark, sf_dir):
    found = features.behavioral_features(header(spark, sf_dir), PARAMS)
    return rounded(found.select("member_id", "weekend_avg_spend", "weekday_avg_spend"))


@query
def days_between_orders(spark, sf_dir):
    return features.days_between_orders(header(spark, sf_dir), PARAMS)


@query
def interpurchase_stats(spark, sf_dir):
    found = features.behavioral_features(header(spark, sf_dir), PARAMS)
    return rounded(
        found.select("member_id", "avg_days_between_orders", "days_between_orders_std")
    )


@query
def product_group_list(spark, sf_dir):
    t = tables(spark, sf_dir)
    found = features.product_features(t.order_header, t.order_item, PARAMS)
    return found.select("member_id", "top_product_groups")


@query
def top3_product_groups(spark, sf_dir):
    t = tables(spark, sf_dir)
    return features.top_product_groups(t.order_header, t.order_item, PARAMS)


@query
def recency_bucket(spark, sf_dir):
    found = features.recency(header(spark, sf_dir), PARAMS)
    return found.groupBy("recency_bucket").agg(F.count("*").alias("n"))


# --- exploration -------------------------------------------------------------------------


@query
def summary_stats(spark, sf_dir):
    found = profile.summary_stats(header(spark, sf_dir), PARAMS)
    return rounded(found, avg_order_value=4)


@query
def data_quality(spark, sf_dir):
    return profile.data_quality(header(spark, sf_dir))


@query
def distinct_counts(spark, sf_dir):
    return profile.distinct_counts(header(spark, sf_dir))


@query
def missing_values(spark, sf_dir):
    return profile.missing_values(dataset(spark, sf_dir))


@query
def tier_list(spark, sf_dir):
    return profile.tier_list(dataset(spark, sf_dir))


@query
def date_scalars(spark, sf_dir):
    on = F.col("order_date")
    return header(spark, sf_dir).select(
        "id",
        scalars.days_before(PARAMS.as_of, on).alias("days_ago"),
        F.date_sub(on, 60).alias("day_60_before"),
        F.trunc(on, "month").alias("month_start"),
        scalars.weekday(on).alias("dow"),
    )


@query
def math_scalars(spark, sf_dir):
    paid = F.col("grand_total")
    return rounded(
        header(spark, sf_dir).select(
            "id",
            F.log1p(paid).alias("log_total"),
            F.abs(paid - 200000.0).alias("distance"),
            scalars.ratio(paid, F.nullif(F.col("id") % 5, F.lit(0)).cast("double")).alias(
                "part"
            ),
            (paid * 2 + 1).alias("line"),
        )
    )


@query
def seasonality_features(spark, sf_dir):
    made = scalars.seasonality(F.col("order_date"))
    return header(spark, sf_dir).select(
        "id", *[c.alias(n) for n, c in made.items()]
    )


# --- segmentation ------------------------------------------------------------------------


def _scored(df: DataFrame, name: str) -> DataFrame:
    return df.select("member_id", TIER, name)


@query
def recency_score(spark, sf_dir):
    return _scored(rfm.recency_score(dataset(spark, sf_dir)), "R_score")


@query
def frequency_score(spark, sf_dir):
    return _scored(rfm.frequency_score(dataset(spark, sf_dir)), "F_score")


@query
def monetary_score(spark, sf_dir):
    return _scored(rfm.monetary_score(dataset(spark, sf_dir)), "M_score")


@query
def rfm_scores(spark, sf_dir):
    return rfm.rfm_scores(dataset(spark, sf_dir)).select(
        "member_id", TIER, "R_score", "F_score", "M_score", "RFM_score"
    )


@query
def rfm_segments(spark, sf_dir):
    return rfm.rfm_segments(dataset(spark, sf_dir)).select(
        "member_id", TIER, "RFM_score", "segment"
    )


@query
def segment_analysis(spark, sf_dir):
    return rfm.segment_analysis(rfm.rfm_segments(dataset(spark, sf_dir)))


@query
def segment_counts(spark, sf_dir):
    return rfm.segment_counts(rfm.rfm_segments(dataset(spark, sf_dir)))


@query
def segment_churn(spark, sf_dir):
    return rounded(analysis.segment_churn(rfm.rfm_segments(dataset(spark, sf_dir))), 6)


# --- analysis ----------------------------------------------------------------------------


@query
def churn_counts(spark, sf_dir):
    return analysis.churn_counts(dataset(spark, sf_dir))


@query
def churn_by_recency(spark, sf_dir):
    return rounded(analysis.churn_by_recency(dataset(spark, sf_dir)), 6)


@query
def churn_by_tier(spark, sf_dir):
    return rounded(analysis.churn_by_tier(dataset(spark, sf_dir)), 6)


@query
def recency_histogram(spark, sf_dir):
    return rounded(analysis.recency_histogram(dataset(spark, sf_dir)), 6, density=9)


@query
def aov_log_histogram(spark, sf_dir):
    return rounded(analysis.aov_log_histogram(dataset(spark, sf_dir)), 6)


@query
def gmv_histogram(spark, sf_dir):
    return rounded(analysis.gmv_histogram(dataset(spark, sf_dir)), 6, density=12)


@query
def probability_histogram(spark, sf_dir):
    predicted = closed_score(dataset(spark, sf_dir))
    return rounded(analysis.probability_histogram(predicted), 6)


@query
def frequency_monetary_grid(spark, sf_dir):
    return analysis.frequency_monetary_grid(dataset(spark, sf_dir))


@query
def frequency_recency_grid(spark, sf_dir):
    return analysis.frequency_recency_grid(dataset(spark, sf_dir))


@query
def feature_correlations(spark, sf_dir):
    return rounded(correlation.correlation_matrix(dataset(spark, sf_dir)), 6)


@query
def top_churn_correlations(spark, sf_dir):
    matrix = correlation.correlation_matrix(dataset(spark, sf_dir))
    return rounded(correlation.top_correlations(matrix, "is_churned"), 6)


@query
def insights(spark, sf_dir):
    data = dataset(spark, sf_dir)
    segmented = rfm.rfm_segments(data)
    return rounded(analysis.insights(segmented, closed_score(data)), 3)


@query
def dashboard_join(spark, sf_dir):
    data = dataset(spark, sf_dir)
    joined = analysis.dashboard_join(data, closed_score(data))
    return rounded(
        joined.select("member_id", TIER, "is_churned", "churn_probability", "risk_segment"), 6
    )


@query
def risk_counts(spark, sf_dir):
    data = dataset(spark, sf_dir)
    return analysis.risk_counts(analysis.dashboard_join(data, closed_score(data)))


@query
def risk_segment(spark, sf_dir):
    return rounded(
        closed_score(dataset(spark, sf_dir)).select(
            "member_id", TIER, "churn_probability", "predicted_churn", "risk_segment"
        ),
        6,
    )


@query
def risk_segment_performance(spark, sf_dir):
    return analysis.risk_segment_performance(closed_score(dataset(spark, sf_dir)))


@query
def risk_segment_all_bands(spark, sf_dir):
    """Also bands without rows: here the rows of the top band are left out."""
    scored = closed_score(dataset(spark, sf_dir)).where("risk_segment <> 'High Risk'")
    return analysis.risk_segment_performance(scored, all_bands=True)


@query
def prediction_join_fanout(spark, sf_dir):
    data = dataset(spark, sf_dir)
    return rounded(scoring.prediction_join_fanout(data, closed_score(data)), 6)


# --- evaluation ----------------------------------------------------------------------------


@query
def roc_auc(spark, sf_dir):
    return rounded(evaluation.roc_auc(closed_score(dataset(spark, sf_dir))), 9)


@query
def roc_curve(spark, sf_dir):
    return rounded(evaluation.roc_curve(closed_score(dataset(spark, sf_dir))), 9)


@query
def pr_curve(spark, sf_dir):
    return rounded(evaluation.pr_curve(closed_score(dataset(spark, sf_dir))), 9)


@query
def average_precision(spark, sf_dir):
    return rounded(evaluation.average_precision(closed_score(dataset(spark, sf_dir))), 9)


@query
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_matrix(closed_score(dataset(spark, sf_dir)))


@query
def precision_recall(spark, sf_dir):
    return rounded(evaluation.precision_recall(closed_score(dataset(spark, sf_dir))), 9)


# --- model features -----------------------------------------------------------------------


def _tier_rows(spark, sf_dir, *tiers: str) -> DataFrame:
    known = prepare.with_known_tier(dataset(spark, sf_dir))
    rows = known.where(F.col(TIER).isin(*tiers))
    made = prepare.tier_features(rows.columns, tiers[0])
    return rounded(
        rows.select("member_id", TIER, *[c.alias(n) for n, c in made.items()])
    )


@query
def tier_features_vvip(spark, sf_dir):
    return _tier_rows(spark, sf_dir, "VVIP")


@query
def tier_features_gold(spark, sf_dir):
    return _tier_rows(spark, sf_dir, "GOLD")


@query
def tier_features_silver(spark, sf_dir):
    return _tier_rows(spark, sf_dir, "SILVER")


@query
def tier_features_value(spark, sf_dir):
    return _tier_rows(spark, sf_dir, "BLACK", "BRONZE")


@query
def interaction_features(spark, sf_dir):
    rows = dataset(spark, sf_dir)
    made = prepare.interaction_features(rows.columns)
    return rounded(rows.select("member_id", TIER, *[c.alias(n) for n, c in made.items()]))


@query
def impute_numeric(spark, sf_dir):
    """The medians of all numeric columns, as (feature, median)."""
    data = dataset(spark, sf_dir)
    names = [c for c in correlation.numeric_columns(data) if c not in prepare.EXCLUDED]
    medians = exact_quantiles(data, names, [0.5])
    filled = data.agg(
        *[F.sum(F.coalesce(F.col(c), F.lit(medians[c][0]))).alias(c) for c in names]
    )
    return rounded(
        filled.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(c).alias("feature"),
                            F.lit(medians[c][0]).cast("double").alias("median"),
                            F.col(c).cast("double").alias("filled_sum"),
                        )
                        for c in names
                    ]
                )
            )
        ),
        2,
    )


@query
def ffill_days(spark, sf_dir):
    data = feature_rows(spark, sf_dir).select("member_id", TIER, "days_between_orders_std")
    order = [F.asc_nulls_last(c) for c in prepare.ROW_ORDER]
    return rounded(forward_filled(data, order, ["days_between_orders_std"]))


@query
def impute_categorical(spark, sf_dir):
    data = dataset(spark, sf_dir)
    names = correlation.text_columns(data)
    return prepare.category_modes(prepare.category_counts(data, names)).select(
        F.col("column").alias("feature"), F.col("mode").alias("fill_value")
    )


@query
def label_encode(spark, sf_dir):
    data = dataset(spark, sf_dir)
    names = correlation.text_columns(data)
    return prepare.label_codes(prepare.category_counts(data, names)).select(
        F.col("column").alias("feature"), "value", F.col("code").cast("long").alias("code")
    )


@query
def prepared_features(spark, sf_dir):
    data = dataset(spark, sf_dir)
    prep = prepare.fit_preparation(data)
    keyed = data.withColumn("row_tier", F.coalesce(F.col(TIER), F.lit("none")))
    ready = prepare.prepared_features(keyed, prep, ["member_id", "row_tier", "is_churned"])
    return rounded(ready)


@query
def prepared_gaps(spark, sf_dir):
    """The preparation of all feature rows, where forward fill has gaps to fill."""
    data = feature_rows(spark, sf_dir)
    prep = prepare.fit_preparation(data)
    keyed = data.withColumn("row_tier", F.coalesce(F.col(TIER), F.lit("none")))
    return rounded(prepare.prepared_features(keyed, prep, ["member_id", "row_tier"]))


@query
def prepared_unseen(spark, sf_dir):
    """All rows prepared by a fit on the GOLD rows: most classes are unknown to it."""
    data = dataset(spark, sf_dir)
    prep = prepare.fit_preparation(data.where(F.col(TIER) == "GOLD"))
    keyed = data.withColumn("row_tier", F.coalesce(F.col(TIER), F.lit("none")))
    ready = prepare.prepared_features(keyed, prep, ["member_id", "row_tier", "is_churned"])
    return rounded(ready)


@query
def align_features(spark, sf_dir):
    """The model's column list meets a batch that lacks one column and has others."""
    data = dataset(spark, sf_dir).drop("avg_quantity_per_item")
    wanted = ["total_gmv", "avg_quantity_per_item", "total_orders", "brand_diversity"]
    return rounded(prepare.aligned(data, wanted, ["member_id", TIER]))


@query
def unseen_categories(spark, sf_dir):
    """Per tier route, the texts of all other rows that its fit does not know."""
    data = prepare.with_known_tier(dataset(spark, sf_dir))
    found = prepare.unseen_by_route(
        data, sorted(MODEL.min_rows), correlation.text_columns(data)
    )
    return found.withColumnRenamed("column", "feature")


@query
def tier_eligibility(spark, sf_dir):
    return training.tier_eligibility(dataset(spark, sf_dir), MODEL)


@query
def class_weights(spark, sf_dir):
    return rounded(training.class_weights(dataset(spark, sf_dir), MODEL), 6)


# --- models ----------------------------------------------------------------------------------


@query
def train_tier_models(spark, sf_dir):
    model = fitted(spark, sf_dir)
    found = training.training_metrics(model, spark)
    return rounded(found.where(F.col("model") != "global").drop("auc"), 9)


@query
def train_global_model(spark, sf_dir):
    found = training.training_metrics(fitted(spark, sf_dir), spark)
    return rounded(found.where(F.col("model") == "global").drop("auc"), 9)


def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_members(dataset(spark, sf_dir), fitted(spark, sf_dir))


@query
def training_metrics(spark, sf_dir):
    """Figures per model, and whether scoring reproduces the stored AUC: a tier's on its own
    rows, that of the global model on all rows, which it scores where no tier has a model."""
    model = fitted(spark, sf_dir)
    found = training.training_metrics(model, spark)
    scored = scored_rows(spark, sf_dir).where(F.col("model_used") == "tier_specific")
    everywhere = dataclasses.replace(model, routes={})
    samples = {tier: scored.where(F.col(TIER) == tier) for tier in model.tiers}
    samples["global"] = scoring.score_members(dataset(spark, sf_dir), everywhere)
    parts = [
        evaluation.roc_auc(rows, "is_churned").select(
            F.lit(name).alias("model"), F.col("auc").alias("again")
        )
        for name, rows in samples.items()
    ]
    again = functools.reduce(DataFrame.unionByName, parts)
    return found.join(again, "model").select(
        "model",
        "sample_size",
        F.round("churn_rate", 9).alias("churn_rate"),
        "churn_count",
        "feature_count",
        (F.abs(F.col("auc") - F.col("again")) < 1e-9).alias("auc_reproduced"),
        F.col("auc").between(0.7, 1.0).alias("auc_plausible"),
    )


@query
def score_members(spark, sf_dir):
    """Which model scored each row, and whether the score is a probability."""
    return scored_rows(spark, sf_dir).select(
        "member_id",
        TIER,
        "model_used",
        "prediction_tier",
        F.col("churn_probability").between(0, 1).alias("is_probability"),
    )


@query
def predictions(spark, sf_dir):
    """Actual class, and whether class and band follow from the probability."""
    found = scoring.predictions(dataset(spark, sf_dir), fitted(spark, sf_dir))
    p = F.col("churn_probability")
    band = (
        F.when(p <= 0.3, "Low Risk").when(p <= 0.7, "Medium Risk").otherwise("High Risk")
    )
    return found.select(
        "member_id",
        TIER,
        "actual_churn",
        ((F.col("predicted_churn") == 1) == (p >= 0.5)).alias("class_follows"),
        (F.col("risk_segment") == band).alias("band_follows"),
    )


@query
def score_ranking(spark, sf_dir):
    """Per model, whether churners score higher on average than the others."""
    churned = F.col("is_churned") == 1
    p = F.col("churn_probability")
    return (
        scored_rows(spark, sf_dir)
        .groupBy("prediction_tier")
        .agg(
            F.count("*").alias("rows"),
            (F.avg(F.when(churned, p)) > F.avg(F.when(~churned, p))).alias("ordered"),
        )
    )


@query
def feature_importance(spark, sf_dir):
    """Per model: number of features, that the importances of all are shares of 1, and that
    the first 20 are those of the largest importance, by name on ties."""
    model = fitted(spark, sf_dir)
    found = training.feature_importance(model, spark, top_n=1000)
    best = training.feature_importance(model, spark).select(
        "model", "feature", F.col("place").alias("best_place")
    )
    order = Window.partitionBy("model").orderBy(F.desc("importance"), "feature")
    ranked = found.join(best, ["model", "feature"], "left").withColumn(
        "again", F.row_number().over(order)
    )
    cut = F.when(F.col("again") <= 20, F.col("again"))
    return ranked.groupBy("model").agg(
        F.count("*").alias("features"),
        F.countDistinct("feature").alias("names"),
        F.count("best_place").alias("first_features"),
        F.min(F.col("best_place").eqNullSafe(cut)).alias("first_are_best"),
        F.round(F.sum("importance"), 6).alias("total"),
        F.min(F.col("importance") >= 0).alias("none_negative"),
        F.max(F.when(F.col("place") == 1, F.col("importance")) > 0).alias("first_positive"),
    )


@query
def model_summary(spark, sf_dir):
    """The summary; an AUC is shown as whether it is better than chance."""
    found = training.model_summary(fitted(spark, sf_dir), spark)
    better = F.when(F.col("value").between(0.5, 1), 1.0).otherwise(0.0)
    value = F.when(F.col("metric") == "auc", better).otherwise(F.round("value", 9))
    return found.select("entity", "metric", value.alias("value"))


@query
def model_roundtrip(spark, sf_dir):
    """Whether a saved and reloaded model gives every row the same prediction."""
    model = fitted(spark, sf_dir)
    folder = scoring.save_model(model, _scratch(spark), spark)
    first = stored(scoring.predictions(dataset(spark, sf_dir), model))
    second = scoring.predictions(dataset(spark, sf_dir), scoring.load_model(folder, spark))
    other = second.select(
        F.col("member_id").alias("other_member"),
        F.col(TIER).alias("other_tier"),
        F.col("churn_probability").alias("other_probability"),
    )
    same_row = F.col("member_id").eqNullSafe(F.col("other_member")) & F.col(TIER).eqNullSafe(
        F.col("other_tier")
    )
    return first.join(other, same_row, "full").select(
        "member_id",
        TIER,
        F.col("churn_probability").eqNullSafe(F.col("other_probability")).alias("same"),
    )


@query
def model_comparison(spark, sf_dir):
    """Cross-validated figures of the model families, as whether they are plausible."""
    found = training.model_comparison(dataset(spark, sf_dir), MODEL)
    return found.select(
        "algorithm",
        F.col("cv_mean_auc").between(0.5, 1).alias("better_than_chance"),
        F.col("cv_std_auc").between(0, 0.25).alias("steady"),
    )


@query
def churn_report(spark, sf_dir):
    """The report without what only a trained model can tell (AUC and importances)."""
    t = tables(spark, sf_dir)
    found = report.churn_report(
        cohort.cohort_analysis(t.order_header, PARAMS),
        profile.churn_stats(labels.churn_labels(t.order_header, PARAMS)),
        fitted(spark, sf_dir),
        dataset(spark, sf_dir),
    )
    kept = (F.col("section") != "top_features") & (F.col("metric") != "auc")
    return rounded(found.where(kept))


@query
def whole_run(spark, sf_dir):
    """Rows and churners of every output of a run that is started twice: the second start
    finds all stages finished (``resumed``) and the figures are of what it reads."""
    t, folder = tables(spark, sf_dir), _scratch(spark)
    model = fitted(spark, sf_dir)
    first = run(t, PARAMS, MODEL, folder, model)
    done = run(t, PARAMS, MODEL, folder, model)
    kept = (F.col("section") != "top_features") & (F.col("metric") != "auc")
    none = F.lit(None).cast("long")
    outputs = {
        "cohort": (done.cohort, none),
        "labels": (done.labels, F.sum("is_churned")),
        "dataset": (done.dataset, F.sum("is_churned")),
        "predictions": (done.predictions, F.sum("actual_churn")),
        "report": (done.report.where(kept), none),
    }
    parts = [
        df.agg(F.count("*").alias("rows"), churned.cast("long").alias("churned")).select(
            F.lit(name).alias("output"),
            "rows",
            "churned",
            F.lit(done.paths == first.paths).alias("resumed"),
        )
        for name, (df, churned) in outputs.items()
    ]
    return functools.reduce(DataFrame.unionByName, parts)
