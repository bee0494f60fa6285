import pytest
from pyspark.sql import functions as F

from ebbtide.params import ChurnParams
from ebbtide.plans import cohort
from ebbtide.plans.labels import churn_labels
from tests.conftest import AS_OF


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_window_limits(orders, params):
    days = [0, 30, 59, 60, 61, 90, 120, 121, 180, 365, 366, -5]
    row = one(churn_labels(orders([{"days": d, "total": 2.0**i} for i, d in enumerate(days)]), params))
    # 0, 30, 59, 60 days ago and the order dated after as_of; 366 is out of the history.
    assert row.spend_last_60_days == 1 + 2 + 4 + 8 + 2048
    assert row.spend_previous_60_days == 16 + 32 + 64
    assert row.historical_60day_baseline == pytest.approx((128 + 256 + 512) / 3 * 2)


def test_fewer_than_three_orders_have_no_label(orders, params):
    rows = [{"member": m, "days": d} for m, n in ((1, 1), (2, 2), (3, 3)) for d in range(n)]
    assert one(churn_labels(orders(rows), params)).member_id == 3


def test_threshold_is_inclusive(orders, params):
    def label(now):
        rows = [{"days": 10, "total": now}, {"days": 70, "total": 60.0}, {"days": 80, "total": 40.0}]
        return one(churn_labels(orders(rows), params))

    assert label(50.0).churned_vs_previous == 1
    assert label(50.01).churned_vs_previous == 0
    assert label(50.0).churned_vs_baseline == 0  # no history: NULL is not churned


def test_null_member_and_null_amount(orders, params):
    rows = [{"member": None, "days": d, "total": None if d == 1 else 5.0} for d in (1, 2, 3)]
    row = one(churn_labels(orders(rows), params))
    assert row.member_id is None and row.spend_last_60_days == 10.0


def test_only_null_amounts_sum_to_null(orders, params):
    rows = [{"days": 1, "total": None}]
    row = one(cohort.periodic_spend(orders(rows), params))
    assert row.spend_last_30_days is None and row.total_gmv is None
    assert row.historical_spend == 0.0 and row.total_visits == 1


def test_cohort_window_limits(orders, params):
    rows = [{"days": d, "total": 2.0**i} for i, d in enumerate([29, 30, 59, 60, 119, 120, 400])]
    row = one(cohort.periodic_spend(orders(rows), params))
    assert row.spend_last_30_days == 1
    assert row.spend_last_60_days == 7
    assert row.spend_last_120_days == 31
    assert row.historical_spend == 32 + 64
    assert row.historical_transaction_days == 2
    assert row.total_orders == 7 and row.total_visits == 7


def test_repeated_order_id_and_day_count_once(orders, params):
    rows = [{"days": 5, "id": 9}, {"days": 5, "id": 9}, {"days": 5, "id": 8}, {"days": 6, "id": 9}]
    row = one(cohort.periodic_spend(orders(rows), params))
    assert (row.total_orders, row.total_visits, row.total_gmv) == (2, 2, 400.0)


@pytest.mark.parametrize(
    "history, guard, known", [(0, False, False), (1, False, False), (2, False, True), (0, True, False), (1, True, True)]
)
def test_history_days(orders, history, guard, known):
    params = ChurnParams(as_of=AS_OF, guard_zero=guard)
    rows = [{"days": 10}] + [{"days": 200 + i} for i in range(history)]
    flags = cohort.cohort_flags(cohort.periodic_spend(orders(rows), params), params)
    row = one(flags)
    assert (row.historical_daily_avg_spend is not None) == known
    assert (row.churn_60_day_spend is not None) == known


def test_cohort_filters_nulls_and_adds_global(orders, params):
    rows = [
        {"member": 1, "tier": "GOLD", "days": 1},
        {"member": 2, "tier": "VVIP", "days": 300},
        {"member": 3, "tier": None, "days": 1},
        {"member": None, "tier": "GOLD", "days": 1},
    ]
    found = {r.tier: r for r in cohort.cohort_analysis(orders(rows), params).collect()}
    assert set(found) == {"GOLD", "VVIP", "Global"}
    assert found["Global"].churn_rate_120_day_visit == 0.5
    assert found["GOLD"].avg_monthly_visits == pytest.approx(30.44)


def test_one_pass_equals_union(spark, orders, params):
    rows = [{"member": m, "tier": t, "days": m * 37 % 400, "total": float(m)} for m in range(60) for t in ("A", "B")]
    o = orders(rows)
    a, b = cohort.cohort_analysis(o, params), cohort.cohort_union(o, params)
    digits = [F.round(c, 9).alias(c) if c != "tier" else c for c in a.columns]
    assert a.select(*digits).exceptAll(b.select(*digits)).isEmpty()


def test_flags_imply_label(modelling, spark, params):
    from ebbtide.checks.queries import tables
    from tests.conftest import DATA

    labels = churn_labels(tables(spark, DATA).order_header, params)
    wrong = labels.where(
        F.col("is_churned") != F.greatest("churned_vs_previous", "churned_vs_baseline")
    )
    assert wrong.isEmpty()
