"""What the plans must look like for large tables, and results with very uneven keys."""

import re

import pytest
from pyspark.sql import functions as F

from ebbtide.checks.queries import PARAMS, tables
from ebbtide.plans import cohort, features
from ebbtide.plans.labels import churn_labels
from tests.conftest import DATA


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def source(spark):
    return tables(spark, DATA)


def test_history_filter_and_columns_reach_the_scan(source):
    text = plan(churn_labels(source.order_header, PARAMS))
    assert "GreaterThanOrEqual(o_orderdate,2000-08-01" in text
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text
    assert text.count("hashpartitioning") == 1


def test_every_feature_scan_is_filtered(source):
    text = plan(features.feature_set(source.order_header, source.order_item, PARAMS))
    scans = re.findall(r"PushedFilters: \[([^\]]*)\]\nReadSchema: struct<([^>]*)>", text)
    headers = [filters for filters, schema in scans if "o_orderdate" in schema]
    assert len(headers) == 4  # numbers, outlets, lines, days
    assert all("GreaterThanOrEqual(o_orderdate" in filters for filters in headers)
    # Members without a match are dropped before their lines and days are aggregated.
    assert sum("IsNotNull(o_custkey)" in filters for filters in headers) == 2
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_no_sort_or_window_on_raw_orders_of_a_member(source):
    text = plan(features.behavioral_features(source.order_header, PARAMS))
    before_window = text.split("Window")[0]
    assert "HashAggregate" in text and before_window
    # The first exchange is keyed by member and day, not by member alone.
    first = re.search(r"hashpartitioning\(([^)]*)\)", text).group(1)
    assert "order_date" in text and first


def test_cohort_rows_and_total_share_one_scan(source):
    text = plan(cohort.cohort_analysis(source.order_header, PARAMS))
    assert text.count("Scan parquet") == 2  # tree line and detail of one scan


def test_unused_features_are_not_computed(source):
    wide = features.feature_set(source.order_header, source.order_item, PARAMS)
    text = plan(wide.select("member_id", "total_gmv"))
    assert "lineitem" not in text and "l_partkey" not in text


def test_one_member_with_a_third_of_all_orders(spark, params):
    """The results for a dominant member are whole, and equal plain SQL."""
    header = spark.range(30_000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, None).otherwise(F.when(F.col("id") % 3 == 1, 1).otherwise(F.col("id") % 500)).cast("long").alias("member_id"),
        F.date_sub(F.lit(params.as_of), (F.col("id") % 700).cast("int")).cast("timestamp").alias("order_ts"),
        F.date_sub(F.lit(params.as_of), (F.col("id") % 700).cast("int")).alias("order_date"),
        (F.col("id") % 97).cast("double").alias("grand_total"),
        F.concat(F.lit("o"), F.col("id") % 7).alias("outlet_name"),
        F.when(F.col("id") % 5 > 0, "GOLD").alias("member_tier_when_transact"),
        F.col("id").cast("string").alias("order_number"),
    )
    header.createOrReplaceTempView("uneven")
    expected = spark.sql(
        """SELECT member_id, member_tier_when_transact, count(distinct id) AS total_orders,
             count(distinct trunc(order_date, 'month')) AS active_months,
             round(sum(grand_total), 4) AS total_gmv,
             round(stddev(grand_total), 6) AS order_value_std,
             count(distinct outlet_name) AS outlet_diversity,
             mode() WITHIN GROUP (ORDER BY outlet_name) AS primary_outlet
           FROM uneven WHERE order_date >= DATE '2000-08-01' GROUP BY 1, 2"""
    )
    found = features.base_features(header, params).select(
        "member_id", "member_tier_when_transact", "total_orders", "active_months",
        F.round("total_gmv", 4), F.round("order_value_std", 6), "outlet_diversity", "primary_outlet",
    )
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_numbers_stay_in_hash_aggregates(source):
    header, items = source.order_header, source.order_item
    for df in (
        features.base_features(header, PARAMS),
        features.days_between_orders(header, PARAMS),
        features.feature_set(header, items, PARAMS),
    ):
        assert "SortAggregate" not in plan(df)


def test_scoring_reads_all_routes_together_and_sorts_no_rows(spark, model):
    """Scoring rows with gaps: a scan for rows with gaps and one for those without, one model
    step, whatever the number of routes; only fills (narrow, stored) were ordered."""
    from ebbtide.checks.queries import feature_rows
    from ebbtide.plans.scoring import score_members

    text = plan(score_members(feature_rows(spark, DATA), model))
    assert len(model.tiers) > 1
    assert text.count("Scan parquet") == 4  # tree line and detail of each
    assert len(re.findall(r"\) ArrowEvalPython", text)) == 1
    assert "Window" not in text and "rangepartitioning" not in text


def test_limits_of_rank_quintiles_are_not_sorted_for(spark, modelling, monkeypatch):
    """No job range-partitions the rows, and what reaches the driver is a few keys."""
    from ebbtide.operators import ordering, selection
    from ebbtide.plans import rfm

    def refused(*args):
        raise AssertionError("rows were sorted")

    monkeypatch.setattr(ordering, "numbered", refused)
    monkeypatch.setattr(selection, "FINAL_ROWS", 100)
    assert "rangepartitioning" not in plan(rfm.rfm_scores(modelling))


def test_fills_do_not_multiply_rows_that_share_a_key(spark):
    from ebbtide.plans.prepare import with_filled_days

    rows = [(1, "a", 5, "x"), (2, "a", None, "y"), (2, "a", None, "y"), (3, "a", 7, "z"), (3, "a", None, "w"), (None, None, None, "v")]
    df = spark.createDataFrame(rows, "member_id long, member_tier_when_transact string, days_x int, text string")
    found = with_filled_days(df.repartition(3)).collect()
    got = sorted((r.member_id or 0, r.text, r._filled_days_x) for r in found)
    assert got == [(0, "v", 7), (1, "x", 5), (2, "y", 5), (2, "y", 5), (3, "w", 7), (3, "z", 7)]
