"""All routes prepared, and scored, in one pass: the values must be those of one route at a time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.checks.queries import feature_rows
from ebbtide.operators import quantiles
from ebbtide.operators.ensembles import ensemble_probability
from ebbtide.params import GLOBAL_ROUTE, TIER
from ebbtide.plans import prepare, scoring
from ebbtide.plans.prepare import FALLBACK, NUMBER
from ebbtide.plans.training import route_number, training_vectors
from ebbtide.session import pinned
from tests.conftest import DATA

TIERS = ["GOLD", "SILVER", "VVIP"]
ROUTES = {**dict(enumerate(TIERS)), FALLBACK: GLOBAL_ROUTE}


@pytest.fixture(scope="module")
def gappy(spark):
    """Feature rows with known tiers, route numbers and gaps in many columns."""
    rows = prepare.with_known_tier(feature_rows(spark, DATA))
    rows = rows.withColumn("is_churned", F.col("member_id") % 2)
    return pinned(rows.withColumn(NUMBER, route_number(TIERS)))


@pytest.fixture(scope="module")
def preps(gappy):
    return prepare.fit_preparations(gappy, ROUTES)


def part(df, number):
    held = df if number == FALLBACK else df.where(F.col(NUMBER) == number)
    return held.drop(NUMBER)


def codes(prep):
    return {(r.column, r.value): r.code for r in prep.codes.collect()}


@pytest.mark.parametrize("number", ROUTES)
def test_preparation_equals_the_one_of_a_single_route(gappy, preps, number):
    alone = prepare.fit_preparation(part(gappy, number), ROUTES[number])
    together = preps[number]
    assert together.feature_names == alone.feature_names
    assert together.medians == alone.medians
    assert together.mode_codes == alone.mode_codes
    assert codes(together) == codes(alone)


def test_vectors_equal_the_prepared_features(gappy, preps):
    """Each route's training vectors against its own rows prepared alone."""
    found = {}
    for r in training_vectors(gappy.withColumn("is_churned", F.hash("member_id", TIER)), preps).collect():
        found.setdefault(r[NUMBER], []).append((r.is_churned, *r.features))
    for number, prep in preps.items():
        rows = part(gappy, number).withColumn("is_churned", F.hash("member_id", TIER))
        ready = prepare.prepared_features(rows, prep, ["is_churned"])
        wanted = [tuple(r) for r in ready.collect()]
        assert sorted(found[number]) == sorted(wanted) and wanted


def test_number_of_jobs_does_not_depend_on_the_routes(spark, gappy):
    def jobs(routes):
        group = f"jobs-{len(routes)}"
        spark.sparkContext.setJobGroup(group, group)
        prepare.fit_preparations(gappy, routes)
        spark.sparkContext.setJobGroup("", "")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few, many = jobs({FALLBACK: GLOBAL_ROUTE}), jobs(ROUTES)
    # Adaptive plans may run a stage more or less as a job of its own.
    assert abs(many - few) <= 2


@pytest.mark.parametrize("final_rows", [1_000_000, 50])
def test_quantiles_by_group(spark, monkeypatch, final_rows):
    """Also with brackets that are narrowed in every group, ties and a group of NULLs."""
    monkeypatch.setattr(quantiles, "FINAL_ROWS", final_rows)
    rows = [(i % 3, float((i * 37) % 101), float(i % 5)) for i in range(900)]
    rows += [(7, None, None), (7, None, 2.5)]
    df = spark.createDataFrame(rows, "g int, x double, y double")
    probs = [0.0, 0.2, 0.5, 0.99, 1.0]
    found = quantiles.grouped_quantiles(df, "g", ["x", "y"], probs)
    for key in (0, 1, 2):
        x = [r[1] for r in rows if r[0] == key]
        y = [r[2] for r in rows if r[0] == key]
        assert found[key, "x"].values == pytest.approx(np.quantile(x, probs))
        assert found[key, "y"].values == pytest.approx(np.quantile(y, probs))
    assert found[7, "x"].rows == 0 and found[7, "x"].values == [None] * len(probs)
    assert found[7, "y"].values == [2.5] * len(probs)
    assert quantiles.grouped_quantiles(df.where("false"), "g", ["x"], probs) == {}


def test_rows_without_a_model_have_no_score(spark, model):
    df = spark.createDataFrame([(5, [1.0]), (5, None), (None, [1.0])], "n int, v array<double>")
    found = df.select(ensemble_probability(spark, {0: model.fallback.trees}, F.col("n"), F.col("v")).alias("p"))
    assert [r.p for r in found.collect()] == [None] * 3


def test_scoring_reads_the_rows_once(model, modelling):
    text = scoring.score_members(modelling, model)._jdf.queryExecution().executedPlan().toString()
    rows = [line for line in text.split("\n") if "Scan parquet" in line]
    assert len(rows) == 1 and text.count("ArrowEvalPython") == 1 and "Union" not in text
