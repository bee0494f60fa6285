import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ebbtide.functions import scalars
from ebbtide.operators import evaluation, histograms, ordering, quantiles, selection
from ebbtide.operators.correlation import correlation_matrix, top_correlations


def frame(spark, values, name="v", kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id long, {name} {kind}")


@pytest.mark.parametrize("n", [2, 4, 5, 7, 23, 101])
def test_rank_quintiles_equal_qcut(spark, n):
    rng = random.Random(n)
    values = [float(rng.randrange(6)) for _ in range(n)]
    df = frame(spark, values).repartition(5)
    found = df.select("id", quantiles.rank_quintile(df, "v", ["id"]).alias("q")).toPandas().sort_values("id")
    ranks = pd.Series(values).rank(method="first")
    if n >= 5:
        expected = pd.qcut(ranks, 5, labels=[1, 2, 3, 4, 5]).astype(int)
    else:
        expected = np.maximum(1, np.ceil(5 * (ranks - 1) / (n - 1))).astype(int)
    assert list(found["q"]) == list(expected)


@pytest.mark.parametrize("final_rows, sample_rows", [(200_000, 50_000), (40, 60), (3, 25)])
@pytest.mark.parametrize("distinct", [1, 4, 3000])
def test_keys_at_ranks_equal_a_sort(spark, monkeypatch, final_rows, sample_rows, distinct):
    """With any bracket size, NULL fields, text fields and repeated keys."""
    monkeypatch.setattr(selection, "FINAL_ROWS", final_rows)
    monkeypatch.setattr(selection, "SAMPLE_ROWS", sample_rows)
    rng = random.Random(distinct)
    rows = []
    for _ in range(1500):
        number = rng.randrange(distinct)
        text = None if number % 7 == 0 else f"t{number % 5}"
        rows.append((float(number % 90), None if number % 11 == 0 else number, text))
    rows += [(None, None, None)] * 2
    df = spark.createDataFrame(rows, "a double, b long, c string").repartition(5)
    ranks = [1, 2, 299, 700, 1200, 1501, 1502]
    total, found = selection.keys_at_ranks(df.select(F.struct("a", "b", "c").alias("k")), lambda n: ranks)
    # NULL fields come first.
    ordered = sorted(rows, key=lambda r: [(v is not None, v if v is not None else 0) for v in r])
    assert total == len(rows)
    assert {r: tuple(k) for r, k in found.items()} == {r: ordered[r - 1] for r in ranks}


def test_keys_at_ranks_of_no_rows(spark):
    none = spark.range(0).select(F.struct("id").alias("k"))
    assert selection.keys_at_ranks(none, lambda n: [1]) == (0, {})


def test_one_value_has_no_quintile(spark):
    df = frame(spark, [3.0])
    row = df.select(
        quantiles.rank_quintile(df, "v", ["id"]).alias("r"), quantiles.value_quintile(df, "v").alias("v")
    ).first()
    assert row.r is None and row.v is None


def test_equal_values_share_the_first_quintile(spark):
    df = frame(spark, [4.0] * 9)
    assert {r.q for r in df.select(quantiles.value_quintile(df, "v").alias("q")).collect()} == {1}


def test_value_quintiles_equal_qcut(spark):
    values = [float((i * 37) % 101) for i in range(101)]
    df = frame(spark, values)
    found = df.select("id", quantiles.value_quintile(df, "v").alias("q")).toPandas().sort_values("id")
    assert list(found["q"]) == list(pd.qcut(pd.Series(values), 5, labels=[1, 2, 3, 4, 5]).astype(int))


@pytest.mark.parametrize("final_rows, accuracy", [(10**6, 10_000), (40, 20), (5, 50)])
def test_quantiles_are_exact_with_any_bracket(spark, monkeypatch, final_rows, accuracy):
    monkeypatch.setattr(quantiles, "FINAL_ROWS", final_rows)
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    rng = random.Random(3)
    rows = [(rng.gauss(0, 1), float(rng.randrange(3)), None if i % 4 else 1.5 * i, None) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    probs = [0.0, 0.1, 0.5, 0.75, 1.0]
    found = quantiles.exact_quantiles(df, ["a", "b", "c", "d"], probs)
    pdf = df.toPandas().astype(float)
    for c in "abc":
        assert found[c] == pytest.approx([pdf[c].quantile(p) for p in probs])
    assert found["d"] == [None] * 5


def test_rank_and_running_sums_with_one_dominant_value(spark):
    values = [7] * 300 + list(range(100))
    df = frame(spark, values, kind="int").repartition(8)
    keys = [F.col("v"), F.col("id")]
    ranked = ordering.with_rank(df, keys).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 401))
    assert [(r.v, r.id) for r in ranked] == sorted((v, i) for i, v in enumerate(values))
    assert {r.rank_rows for r in ranked} == {400}
    summed = ordering.with_running_sums(df, keys, ["v"]).orderBy("v", "id").collect()
    total = 0
    for r in summed:
        total += r.v
        assert r.cum_v == total
    assert {r.all_v for r in summed} == {total}


def test_rank_restarts_per_group(spark):
    df = spark.createDataFrame([(g, v) for g in ("a", "b", None) for v in range(50)], "g string, v int")
    found = ordering.with_rank(df.repartition(6), [F.col("v")], ["g"]).collect()
    assert all(r["rank"] == r.v + 1 and r.rank_rows == 50 for r in found)


def test_forward_fill(spark):
    values = [None, 2.0, None, None, 5.0] + [None] * 200 + [1.0, None]
    df = frame(spark, values).repartition(7)
    found = ordering.forward_filled(df, [F.col("id")], ["v"]).orderBy("id").collect()
    expected = pd.Series(values, dtype=float).ffill()
    assert [r.v for r in found] == [None if math.isnan(v) else v for v in expected]


def test_forward_fill_stays_in_its_group(spark):
    rows = [("a", 1, 1.0), ("a", 2, None), ("b", 1, None), ("b", 2, 3.0), ("b", 3, None)]
    df = spark.createDataFrame(rows, "g string, i int, v double")
    found = ordering.forward_filled(df, [F.col("i")], ["v"], ["g"]).collect()
    assert sorted((r.g, r.i, r.v or 0) for r in found) == [
        ("a", 1, 1.0), ("a", 2, 1.0), ("b", 1, 0), ("b", 2, 3.0), ("b", 3, 3.0)
    ]


def test_risk_bands(spark):
    edges = [0, 0.15, 0.3, 0.300001, 0.5, 0.7, 0.700001, 0.85, 1, None, 1.2, -0.1]
    df = frame(spark, [None if e is None else float(e) for e in edges])
    rows = df.orderBy("id").select(scalars.risk_segment(F.col("v")).alias("s"), scalars.predicted_class(F.col("v")).alias("c")).collect()
    assert [r.s and r.s.split()[0] for r in rows] == [
        "Low", "Low", "Low", "Medium", "Medium", "Medium", "High", "High", "High", None, None, None
    ]
    assert [r.c for r in rows[:9]] == [0, 0, 0, 0, 1, 1, 1, 1, 1]


def test_rfm_segment_limits(spark):
    scores = [3, 4, 5, 7, 9, 11, 13, 15, None]
    df = frame(spark, scores, kind="int").orderBy("id")
    assert [r.s for r in df.select(scalars.rfm_segment(F.col("v")).alias("s")).collect()] == [
        "Lost", "Lost", "Cannot Lose Them", "At Risk", "Potential Loyalists",
        "Loyal Customers", "Champions", "Champions", None,
    ]


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.0, 9.0, None], [5.0, 5.0], [float(i) for i in range(61)], [73.0, 0.0, 365.0, 146.0]])
def test_histogram_equals_numpy(spark, values):
    found = histograms.histogram(frame(spark, values), F.col("v")).orderBy("bin").collect()
    clean = [v for v in values if v is not None]
    counts, edges = np.histogram(clean, bins=30)
    assert [r.n for r in found] == list(counts)
    assert [r.bin_low for r in found] == pytest.approx(list(edges[:-1]))
    density, _ = np.histogram(clean, bins=30, density=True)
    assert [r.density for r in found] == pytest.approx(list(density))


def test_correlations_are_pairwise_complete(spark):
    rng = random.Random(5)
    rows = [
        (rng.random(), rng.random() if i % 3 else None, 1e9 + rng.random(), 4.0, None if i % 2 else float(i))
        for i in range(90)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double, same double, d double").repartition(4)
    expected = df.toPandas().astype(float).corr()
    for r in correlation_matrix(df).collect():
        want = expected.loc[r.feature_a, r.feature_b]
        if math.isnan(want):
            assert r.correlation is None
        else:
            assert r.correlation == pytest.approx(want, abs=1e-6)
    best = top_correlations(correlation_matrix(df), "a", 2).collect()
    assert best[0].feature == "a" and best[0].abs_correlation == pytest.approx(1.0)


def scored(spark, rows):
    return spark.createDataFrame(rows, "actual_churn int, churn_probability double")


def test_auc_by_pairs(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(2), rng.randrange(5) / 4) for _ in range(80)]
    pairs = [(p > n) + 0.5 * (p == n) for a, p in rows if a for b, n in rows if not b]
    auc = evaluation.roc_auc(scored(spark, rows)).first().auc
    assert auc == pytest.approx(sum(pairs) / len(pairs))
    turned = evaluation.roc_auc(scored(spark, [(a, -p) for a, p in rows])).first().auc
    assert turned == pytest.approx(1 - auc)


def test_curves(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (1, 0.4), (0, 0.1)]
    roc = evaluation.roc_curve(scored(spark, rows)).orderBy("fpr", "tpr").collect()
    assert [r.fpr for r in roc] == pytest.approx([0, 0, 0.5, 0.5, 1])
    assert [r.tpr for r in roc] == pytest.approx([0, 1 / 3, 2 / 3, 1, 1])
    pr = {r.threshold: (r.precision, r.recall) for r in evaluation.pr_curve(scored(spark, rows)).collect()}
    assert pr[None] == (1.0, 0.0)
    assert pr[0.8] == pytest.approx((2 / 3, 2 / 3))
    ap = evaluation.average_precision(scored(spark, rows)).first().average_precision
    assert ap == pytest.approx(1 / 3 * 1 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 4)


def test_one_class(spark):
    rows = [(1, 0.2), (1, 0.7)]
    assert evaluation.roc_auc(scored(spark, rows)).first().auc is None
    row = evaluation.precision_recall(scored(spark, [(0, 0.1)])).first()
    assert (row.precision, row.recall) == (0.0, 0.0)


def test_confusion_matrix_is_full(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 1)], "actual_churn int, predicted_churn int")
    found = {(r.actual, r.predicted): r.n for r in evaluation.confusion_matrix(df).collect()}
    assert found == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 2}
