import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from ebbtide.operators.evaluation import roc_auc
from ebbtide.params import GLOBAL_ROUTE, TIER, ModelParams
from ebbtide.plans import prepare, scoring, training
from ebbtide.plans.analysis import dashboard_join
from ebbtide.session import pinned
from tests.conftest import few_rounds


@pytest.fixture(scope="module")
def new_customers(spark):
    """Four profiles without most feature columns and without a tier."""
    return spark.createDataFrame(
        [
            (1, 15, 25, 2500.0, 100.0, 3.0, 5, 8, 2),
            (2, 45, 10, 800.0, 80.0, 1.5, 3, 4, 1),
            (3, 90, 5, 300.0, 60.0, 0.8, 2, 2, 1),
            (4, 120, 2, 100.0, 50.0, 0.3, 1, 1, 1),
        ],
        "member_id long, days_since_last_order int, total_orders int, total_gmv double, "
        "avg_order_value double, avg_orders_per_month double, product_group_diversity int, "
        "brand_diversity int, outlet_diversity int",
    )


def test_routes(model):
    # Rows per tier at this scale: BLACK and BRONZE stay below their minimum.
    assert model.tiers == ["GOLD", "SILVER", "VVIP", "unknown"]
    assert model.fallback is not None and not model.failures


def test_training_results(spark, model, modelling):
    rows = {r.model: r for r in training.training_metrics(model, spark).collect()}
    assert rows[GLOBAL_ROUTE].sample_size == modelling.count()
    assert rows["GOLD"].sample_size == modelling.where(F.col(TIER) == "GOLD").count()
    assert all(0.5 < r.auc <= 1 for r in rows.values())


def test_boosting_settings():
    spec = ModelParams().spec
    assert (spec("VVIP").trees, spec("VVIP").depth, spec("VVIP").step) == (300, 4, 0.05)
    assert (spec("GOLD").trees, spec("SILVER").depth) == (250, 5)
    assert (spec("BLACK").trees, spec("other").step) == (200, 0.1)
    assert (spec(GLOBAL_ROUTE).trees, spec(GLOBAL_ROUTE).depth) == (250, 6)


def test_one_prediction_per_member_and_tier(model, modelling):
    found = pinned(scoring.score_members(modelling, model))
    assert found.count() == modelling.count()
    assert found.select("member_id", TIER).distinct().count() == modelling.count()
    used = {(r[TIER], r.model_used) for r in found.select(TIER, "model_used").distinct().collect()}
    assert ("GOLD", "tier_specific") in used and ("BLACK", "global_fallback") in used
    assert found.where(~F.col("churn_probability").between(0, 1)).isEmpty()


def test_training_auc_is_reproduced_by_scoring(model, modelling):
    found = pinned(scoring.score_members(modelling, model))
    gold = found.where(F.col("prediction_tier") == "GOLD")
    assert roc_auc(gold, "is_churned").first().auc == pytest.approx(
        model.routes["GOLD"].result.auc
    )


def test_save_and_load(spark, model, modelling):
    folder = tempfile.mkdtemp(prefix="run-") + "/model"
    loaded = scoring.load_model(scoring.save_model(model, folder, spark), spark)
    a, b = scoring.predictions(modelling, model), scoring.predictions(modelling, loaded)
    assert a.exceptAll(b).isEmpty()
    assert loaded.params == model.params
    assert loaded.routes["VVIP"].result == model.routes["VVIP"].result


def test_same_seed_same_model(modelling, model):
    rows = modelling.where(F.col(TIER) == "VVIP")
    stats = model.routes["VVIP"].result
    weight = (stats.sample_size - stats.churn_count) / stats.churn_count * 15.0
    again = training.train_route(
        prepare.with_known_tier(rows), "VVIP", weight, stats.sample_size, stats.churn_count, model.params
    )
    assert list(again.preparation.feature_names) == model.routes["VVIP"].preparation.feature_names


def test_importance_and_summary(spark, model):
    top = training.feature_importance(model, spark, 5)
    assert top.groupBy("model").count().where("count <> 5").isEmpty()
    summary = {(r.entity, r.metric): r.value for r in training.model_summary(model, spark).collect()}
    assert summary["model_counts", "tier_specific_models"] == 4
    assert summary["model_counts", "global_fallback"] == 1


def test_new_customers_use_the_fallback(model, new_customers):
    found = scoring.score_members(new_customers, model).collect()
    assert len(found) == 4
    assert {r.model_used for r in found} == {"global_fallback"}


def test_unknown_route_raises_or_is_neutral(modelling, model):
    bare = training.ChurnModel(model.params)
    with pytest.raises(ValueError):
        scoring.score_members(modelling, bare)
    neutral = scoring.score_members(modelling, bare, on_error="neutral")
    assert {(r.churn_probability, r.model_used) for r in neutral.select("churn_probability", "model_used").distinct().collect()} == {(0.5, "default_fallback")}


def test_failing_tier_falls_back(modelling, model, monkeypatch):
    real = training.train_route

    def broken(rows, route, *rest):
        if route != GLOBAL_ROUTE:
            raise RuntimeError("no luck")
        return model.fallback

    monkeypatch.setattr(training, "train_route", broken)
    found = training.train_models(modelling, model.params)
    assert found.tiers == [] and set(found.failures) == {"GOLD", "SILVER", "VVIP", "unknown"}
    assert real is not broken


def test_routes_measured_at_once_have_local_properties_of_their_own(spark, modelling, monkeypatch):
    seen, gate = {}, threading.Barrier(5)

    def measured(rows, route, *figures):
        spark.sparkContext.setLocalProperty("probe", route)
        gate.wait(120)
        seen[route] = spark.sparkContext.getLocalProperty("probe")

    monkeypatch.setattr(training, "train_route", measured)
    found = training.train_models(modelling, few_rounds(1))
    assert not found.failures and len(seen) == 5
    assert all(route == probe for route, probe in seen.items())


def test_single_class_is_an_error(modelling):
    with pytest.raises(ValueError):
        training.train_models(modelling.withColumn("is_churned", F.lit(1)), few_rounds(1))


def test_input_checks(spark, modelling):
    with pytest.raises(ValueError):
        prepare.check_input(modelling.where("false"))
    with pytest.raises(ValueError):
        prepare.check_input(modelling.drop("member_id"))
    with pytest.raises(ValueError):
        prepare.check_input(modelling.drop(TIER), "GOLD")
    prepare.check_input(modelling.drop(TIER))


def test_features_follow_the_columns(modelling):
    assert prepare.tier_features(["avg_discount_rate"], "VVIP").keys() == {"vvip_premium_behavior"}
    assert prepare.tier_features(["outlet_diversity"], "VVIP") == {}
    assert prepare.interaction_features(["total_orders", "outlet_diversity"]).keys() == {"channel_loyalty"}
    assert prepare.engineered(modelling.select("member_id"), GLOBAL_ROUTE).columns == ["member_id"]


def frame(spark, rows):
    return spark.createDataFrame(
        rows,
        "member_id long, member_tier_when_transact string, is_churned int, x double, "
        "days_gap double, empty double, color string, void string",
    )


def test_imputation_and_codes(spark):
    rows = [
        (1, "A", 0, 1.0, None, None, "red", None),
        (2, "A", 1, None, 4.0, None, "blue", None),
        (3, "A", 0, 3.0, None, None, None, None),
        (4, "A", 1, 8.0, 6.0, None, "red", None),
    ]
    prep = prepare.fit_preparation(frame(spark, rows))
    ready = prepare.prepared_features(frame(spark, rows), prep, ["member_id"]).orderBy("member_id").collect()
    assert [r.x for r in ready] == [1.0, 3.0, 3.0, 8.0]
    # Forward fill first, the median of the unfilled column for the leading gap.
    assert [r.days_gap for r in ready] == [5.0, 4.0, 4.0, 6.0]
    assert [r.empty for r in ready] == [0.0] * 4
    assert [r.color_encoded for r in ready] == [1.0, 0.0, 1.0, 1.0]
    assert prep.mode_codes["void"] == 0.0 and {r.void_encoded for r in ready} == {0.0}
    new = frame(spark, [(9, "Z", 0, None, None, 2.0, "green", "new")])
    row = prepare.prepared_features(new, prep).first()
    assert (row.color_encoded, row.void_encoded, row.x, row.days_gap) == (0.0, 0.0, 3.0, 5.0)


def test_tiers_may_have_any_name(spark, modelling):
    """An empty tier name keeps its model, and one called like the fallback its own."""
    name = F.when(F.col(TIER) == "VVIP", "").when(F.col(TIER) == "GOLD", "global")
    renamed = modelling.withColumn(TIER, name.otherwise(F.col(TIER)))
    params = few_rounds(1)
    found = training.train_models(renamed, params)
    assert found.failures == {} and found.tiers == ["", "SILVER", "global", "unknown"]
    assert found.fallback.result.sample_size == modelling.count()
    gold = modelling.where(F.col(TIER) == "GOLD").count()
    assert found.routes["global"].result.sample_size == gold
    used = scoring.score_members(renamed, found).groupBy("prediction_tier", "model_used").count()
    rows = {(r.prediction_tier, r.model_used): r["count"] for r in used.collect()}
    assert rows["global", "tier_specific"] == gold and ("", "tier_specific") in rows


def test_codes_of_many_classes(spark):
    values = [f"v{i % 40:02d}" for i in range(200)]
    df = spark.createDataFrame([(i, i % 2, v) for i, v in enumerate(values)], "member_id long, is_churned int, c string")
    prep = prepare.fit_preparation(df)
    found = prepare.prepared_features(df, prep, ["member_id"]).orderBy("member_id").collect()
    assert [r.c_encoded for r in found] == [float(v[1:]) for v in values]


def test_unseen_categories(spark):
    old = spark.createDataFrame([("a",), ("b",)], "c string")
    new = spark.createDataFrame([("b",), ("z",), (None,)], "c string")
    fitted = prepare.category_counts(old, ["c"])
    assert [tuple(r) for r in prepare.unseen_categories(new, fitted, ["c"]).collect()] == [("c", "z")]


def test_alignment(new_customers):
    found = prepare.aligned(new_customers, ["total_gmv", "absent"], ["member_id"])
    assert found.columns == ["member_id", "total_gmv", "absent"]
    assert {r.absent for r in found.collect()} == {0.0}


def test_dashboard_join_keeps_one_row_each(model, modelling):
    predicted = pinned(scoring.predictions(modelling, model))
    assert dashboard_join(modelling, predicted).count() == modelling.count()
    fanned = scoring.prediction_join_fanout(modelling, predicted).count()
    assert fanned > modelling.count()
    by_member = dashboard_join(modelling, predicted.drop(TIER))
    assert by_member.count() == fanned
