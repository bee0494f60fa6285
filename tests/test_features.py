import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from ebbtide.params import TIER, ChurnParams
from ebbtide.plans import features as f
from ebbtide.plans.labels import churn_labels
from ebbtide.sources.tables import sample_tables
from tests.conftest import AS_OF, DATA


def by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_base_features(orders, params):
    rows = [
        {"days": 10, "total": 10.0, "outlet": "B"},
        {"days": 100, "total": 20.0, "outlet": "A"},
        {"days": 200, "total": 60.0, "outlet": "C"},
        {"days": 200, "total": 70.0, "outlet": None, "tier": "VVIP"},
    ]
    found = by(f.base_features(orders(rows), params), TIER)
    gold = found[("GOLD",)]
    assert (gold.days_since_last_order, gold.customer_age_days) == (10, 200)
    assert (gold.total_orders, gold.active_months, gold.avg_orders_per_month) == (3, 3, 1.0)
    assert (gold.gmv_last_90_days, gold.gmv_previous_90_days) == (10.0, 20.0)
    assert gold.order_value_std == pytest.approx(statistics.stdev([10, 20, 60]))
    assert (gold.outlet_diversity, gold.primary_outlet) == (3, "A")
    assert found[("VVIP",)].primary_outlet is None
    assert found[("VVIP",)].order_value_std is None


def test_outlet_tie_and_majority(orders, params):
    rows = [{"days": i, "outlet": o} for i, o in enumerate("BBAAC")]
    assert f.base_features(orders(rows), params).first().primary_outlet == "A"
    assert f.primary_outlet(orders(rows), params).first().primary_outlet == "A"
    rows.append({"days": 9, "outlet": "B"})
    assert f.base_features(orders(rows), params).first().primary_outlet == "B"


def test_age_zero(orders, items, params):
    row = f.feature_set(orders([{"days": 0}]), items([{"number": "1"}]), params).first()
    assert row.customer_age_days == 0
    assert row.aov_vs_annual_spend_ratio is None
    assert row.spend_growth_rate == 0.0
    assert row.recency_bucket == "very_recent"


def test_product_features(orders, items, params):
    header = orders([{"days": 1, "number": "x"}, {"days": 2, "number": "y"}, {"days": 400, "number": "z"}])
    lines = items(
        [
            {"number": "x", "group": "b", "brand": "k", "sku": "1", "quantity": 2.0, "price": 10.0, "paid": 5.0},
            {"number": "x", "group": "a", "brand": "k", "sku": "2", "quantity": 1.0, "price": 10.0, "paid": 10.0},
            {"number": "y", "group": "b", "brand": None, "sku": "2", "quantity": None},
            {"number": "y", "group": None, "brand": "k", "sku": "3", "quantity": 3.0, "price": 0.0, "paid": 0.0},
            {"number": "z", "group": "old"},
        ]
    )
    row = f.product_features(header, lines, params).first()
    assert (row.product_group_diversity, row.brand_diversity, row.sku_diversity) == (2, 1, 3)
    assert row.top_product_groups == "a|b|b"
    assert row.avg_quantity_per_item == 2.0
    assert row.avg_discount_rate == pytest.approx(20 / 30)


def test_free_lines_have_no_price_ratio(orders, items, params):
    row = f.product_features(orders([{"days": 1}]), items([{"number": "1", "price": 0.0}]), params).first()
    assert row.avg_discount_rate is None


def test_long_group_list_keeps_its_form(orders, items, params):
    lines = items([{"number": "1", "group": g} for g in ["tea"] * 40 + ["cake"] * 2])
    row = f.product_features(orders([{"days": 1}]), lines, params).first()
    assert row.top_product_groups == "|".join(["cake"] * 2 + ["tea"] * 40)
    counts = by(f.product_group_counts(orders([{"days": 1}]), lines, params), "product_group")
    assert counts[("tea",)].lines == 40


def test_top_three_groups(orders, items, params):
    lines = items([{"number": "1", "group": g} for g in "ccbbbaad"])
    assert f.top_product_groups(orders([{"days": 1}]), lines, params).first().top_groups == "b|a|c"


def test_behaviour(orders, params):
    # 2001-08-01 is a Wednesday: 4 days before is Saturday, 3 is Sunday, 5 is Friday.
    days = [4, 3, 5, 12]
    row = f.behavioral_features(orders([{"days": d, "total": float(d)} for d in days]), params).first()
    assert row.favorite_day_of_week == 5
    assert row.weekend_avg_spend == 3.5
    assert row.weekday_avg_spend == 8.5
    assert row.avg_days_between_orders == pytest.approx(3.0)
    assert row.days_between_orders_std == pytest.approx(statistics.stdev([7, 1, 1]))


def test_weekend_only_and_single_order(orders, params):
    found = by(f.behavioral_features(orders([{"days": 4}, {"member": 2, "days": 4}, {"member": 2, "days": 3}]), params), "member_id")
    assert found[(1,)].avg_days_between_orders is None
    assert found[(1,)].weekday_avg_spend is None
    assert found[(2,)].avg_days_between_orders == 1.0
    assert found[(2,)].days_between_orders_std is None


def test_gaps_equal_a_plain_lag(spark, orders, params):
    rows = [
        {"member": m if m else None, "days": (m * 31 + i * i * 7) % 370, "time": dt.time(i % 24)}
        for m in range(6)
        for i in range(25)
    ]
    # Repeated rows, as a join with other tables makes them.
    rows += [{**rows[-1], "id": 149}, {**rows[-1], "id": 149}, {**rows[3], "id": 4}]
    header = orders(rows)
    header.createOrReplaceTempView("gap_orders")
    expected = spark.sql(
        """SELECT member_id, id, datediff(order_date, lag(order_date) OVER (
             PARTITION BY member_id ORDER BY order_ts, id)) AS days_between_orders
           FROM gap_orders WHERE order_date >= DATE '2000-08-01'"""
    )
    found = f.days_between_orders(header, params).select("member_id", "id", "days_between_orders")
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    stats = expected.groupBy("member_id").agg(
        F.round(F.avg("days_between_orders"), 9), F.round(F.stddev("days_between_orders"), 9)
    )
    mine = f.behavioral_features(header, params).select(
        "member_id", F.round("avg_days_between_orders", 9), F.round("days_between_orders_std", 9)
    )
    assert mine.exceptAll(stats).isEmpty()


def test_tier_change_and_null_member(orders, items, params):
    rows = [{"member": 1, "days": d, "tier": t} for d, t in ((1, "GOLD"), (2, "VVIP"), (3, None))]
    rows += [{"member": None, "days": d, "tier": "GOLD"} for d in (1, 2, 3)]
    header = orders(rows)
    features = f.feature_set(header, items([{"number": str(n)} for n in range(1, 7)]), params)
    assert features.columns == f.FEATURE_COLUMNS
    found = by(features, "member_id", TIER)
    assert set(found) == {(1, "GOLD"), (1, "VVIP"), (1, None), (None, "GOLD")}
    # SQL equality: the NULL member gets no product or behaviour columns.
    assert found[(None, "GOLD")].sku_diversity is None
    assert found[(1, None)].sku_diversity == 1
    data = f.final_dataset(churn_labels(header, params), features)
    assert data.count() == 4  # the label join keeps the NULL member


def test_orders_without_lines(orders, items, params):
    row = f.feature_set(orders([{"days": 1}]), items([{"number": "other"}]), params).first()
    assert row.product_group_diversity is None and row.top_product_groups is None


def test_tier_column_is_required(orders, items, params, modelling):
    with pytest.raises(ValueError):
        f.final_dataset(churn_labels(orders([{"days": 1}]), params), modelling.drop(TIER))


def test_lines_of_old_orders_go_before_the_lines_are_joined_with_parts(spark, params):
    found = sample_tables(spark, DATA)
    lines = f.member_lines(found.order_header, found.order_item, params)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    semi, parts = (
        next(i for i, line in enumerate(plan.splitlines()) if text in line)
        for text in ("Join LeftSemi", "Join Inner, (l_partkey")
    )
    assert parts < semi


def test_repeated_order_numbers_repeat_their_lines(orders, items, params):
    header = orders([{"days": 1, "id": 1}, {"days": 2, "id": 1}, {"days": 900, "id": 2}])
    lines = items([{"number": "1", "quantity": 3.0}, {"number": "2"}])
    assert [r.quantity for r in f.member_lines(header, lines, params).collect()] == [3.0, 3.0]


def test_lines_of_old_orders_go_before_they_are_moved(spark, params):
    """Below the exact join, whose sides may be too large for a broadcast."""
    found = sample_tables(spark, DATA)
    lines = f.member_lines(found.order_header, found.order_item, params)
    plan = lines._jdf.queryExecution().optimizedPlan().toString().splitlines()
    exact, marks, parts = (
        next(i for i, line in enumerate(plan) if text in line)
        for text in ("Join LeftSemi, (order_number", "Join LeftSemi, ((", "Join Inner, (l_partkey")
    )
    assert parts < exact < marks


def test_marks_keep_all_keys_and_drop_others(spark, monkeypatch):
    keys = spark.range(0, 4000, 8).selectExpr("cast(id as string) AS k").union(spark.sql("SELECT NULL"))
    rows = spark.range(4000).selectExpr("cast(id as string) AS k")
    kept = {r.k for r in f.marked(rows, keys, "k").collect()}
    assert {str(i) for i in range(0, 4000, 8)} <= kept and len(kept) < 600
    monkeypatch.setattr(f, "MARKS", 1 << 10)
    crowded = {r.k for r in f.marked(rows, keys, "k").collect()}
    assert {str(i) for i in range(0, 4000, 8)} <= crowded and len(crowded) < 4000
