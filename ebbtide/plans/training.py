"""One boosted-tree model per loyalty tier and a global fallback."""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.scalars import ratio
from ebbtide.operators.boosting import even_tasks, fit_ensembles
from ebbtide.operators.ensembles import ensemble_probability
from ebbtide.operators.evaluation import roc_auc
from ebbtide.params import (
    DEFAULT_MIN_ROWS,
    DEFAULT_WEIGHT,
    GLOBAL_ROUTE,
    TIER,
    ModelParams,
)
from ebbtide.plans.prepare import (
    FALLBACK,
    NUMBER,
    Preparation,
    check_input,
    fit_preparation,
    fit_preparations,
    route_vectors,
    with_filled_days,
    with_known_tier,
)
from ebbtide.session import pinned, stored

log = logging.getLogger(__name__)
LABEL = "is_churned"


@dataclass
class RouteResult:
    auc: float | None
    sample_size: int
    churn_rate: float
    churn_count: int
    feature_count: int


@dataclass
class RouteModel:
    route: str
    preparation: Preparation
    # Arrays of its trees, see operators.ensembles.
    trees: dict
    result: RouteResult


@dataclass
class ChurnModel:
    params: ModelParams
    # By tier; the fallback is apart, so a tier may have any name.
    routes: dict[str, RouteModel] = field(default_factory=dict)
    fallback: RouteModel | None = None
    failures: dict[str, str] = field(default_factory=dict)

    @property
    def tiers(self) -> list[str]:
        return sorted(self.routes)

    @property
    def named(self) -> list[tuple[str, RouteModel]]:
        """All models with their names in reports, tiers first."""
        found = [(tier, self.routes[tier]) for tier in self.tiers]
        return found + ([(GLOBAL_ROUTE, self.fallback)] if self.fallback else [])


def _by_tier(values: dict[str, float], default: float) -> Column:
    chain = F.when(F.lit(False), F.lit(default))
    for tier, value in values.items():
        chain = chain.when(F.col("tier") == tier, F.lit(value))
    return chain.otherwise(F.lit(default))


def tier_eligibility(data: DataFrame, params: ModelParams) -> DataFrame:
    """Per tier: rows, churners, required rows, and whether it gets its own model."""
    rows, churned = F.col("sample_size"), F.col("churn_count")
    return (
        with_known_tier(data)
        .groupBy(F.col(TIER).alias("tier"))
        .agg(F.count("*").alias("sample_size"), F.sum(LABEL).cast("long").alias("churn_count"))
        .withColumn("min_samples", _by_tier(params.min_rows, DEFAULT_MIN_ROWS).cast("long"))
        .withColumn(
            "eligible",
            (rows >= F.col("min_samples")) & (churned > 0) & (churned < rows),
        )
    )


def class_weights(data: DataFrame, params: ModelParams) -> DataFrame:
    """Weight of a churner per tier, and for the global model."""
    rows, churned = F.col("sample_size").cast("double"), F.col("churn_count").cast("double")
    balance = ratio(rows - churned, churned)
    per_tier = (
        with_known_tier(data)
        .groupingSets([[F.col(TIER)], []], TIER)
        .agg(
            F.grouping(TIER).alias("is_total"),
            F.count("*").alias("sample_size"),
            F.sum(LABEL).alias("churn_count"),
        )
    )
    tier = F.when(F.col("is_total") == 1, GLOBAL_ROUTE).otherwise(F.col(TIER))
    return per_tier.select(
        tier.alias("tier"),
        balance.alias("churn_ratio"),
        F.when(F.col("is_total") == 1, 1.0)
        .otherwise(_tier_weight(params))
        .alias("business_weight"),
    ).withColumn("positive_weight", F.col("churn_ratio") * F.col("business_weight"))


def _tier_weight(params: ModelParams) -> Column:
    chain = F.when(F.lit(False), F.lit(DEFAULT_WEIGHT))
    for tier, value in params.weights.items():
        chain = chain.when(F.col(TIER) == tier, F.lit(float(value)))
    return chain.otherwise(F.lit(DEFAULT_WEIGHT))


def training_vectors(df: DataFrame, preps: dict[int, Preparation]) -> DataFrame:
    """``_route``, label and ``features`` of the training rows of all routes.

    Rows of ``df`` carry the number of their own route and count for the fallback as well.
    Gaps are filled within each tier for the tiers' models, over all rows for the fallback.
    """
    parts = []
    if preps.keys() - {FALLBACK}:
        parts.append(with_filled_days(df.where(F.col(NUMBER) != FALLBACK), [NUMBER]))
    if FALLBACK in preps:
        parts.append(with_filled_days(df.withColumn(NUMBER, F.lit(FALLBACK))))
    copies = parts[0]
    for part in parts[1:]:
        # A column that is filled in one part only has no gaps in the other.
        copies = copies.unionByName(part, allowMissingColumns=True)
    return route_vectors(copies, preps, [LABEL])


def _fitted_trees(
    vectors: DataFrame,
    preps: dict[int, Preparation],
    weights: dict[int, float],
    rows: int,
    params: ModelParams,
) -> dict[int, dict]:
    """Trees of all routes; ``weights`` are those of a churner."""
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    weight = F.lit(None).cast("double")
    for number, value in weights.items():
        weight = F.when(F.col(NUMBER) == number, F.lit(float(value))).otherwise(weight)
    return fit_ensembles(
        vectors,
        NUMBER,
        "features",
        F.col(LABEL),
        F.when(F.col(LABEL) == 1, weight).otherwise(F.lit(1.0)),
        {number: params.spec(prep.route) for number, prep in preps.items()},
        {number: len(prep.feature_names) for number, prep in preps.items()},
        params.max_bins,
        params.seed,
        even_tasks(rows, params.rows_per_task, cores),
    )


def train_route(
    rows: DataFrame,
    route: str,
    weight: float,
    count: int,
    churned: int,
    params: ModelParams,
    prep: Preparation | None = None,
    trees: dict | None = None,
) -> RouteModel:
    """Fit one route on its rows. With ``prep`` and ``trees`` from a fit of many routes,
    ``rows`` are its rows of :func:`training_vectors` and are only measured."""
    if prep is None or trees is None:
        prep = fit_preparation(rows, route)
        rows = training_vectors(rows.withColumn(NUMBER, F.lit(FALLBACK)), {FALLBACK: prep})
        rows = stored(rows)
        weights = {FALLBACK: weight}
        trees = _fitted_trees(rows, {FALLBACK: prep}, weights, count, params)[FALLBACK]
    # Scored as members are, so that scoring finds the same figure.
    chance = ensemble_probability(rows.sparkSession, {0: trees}, F.lit(0), F.col("features"))
    scored = rows.select(LABEL, chance.alias("churn_probability"))
    auc = roc_auc(scored, LABEL).first()["auc"]
    result = RouteResult(auc, count, churned / count, churned, len(prep.feature_names))
    return RouteModel(route, prep, trees, result)


def route_number(tiers: Sequence[str]) -> Column:
    """Place of a row's tier among ``tiers``, ``FALLBACK`` for any other. Stored tables are
    partitioned by it: a partition value cannot hold every tier name."""
    number = F.lit(FALLBACK)
    for place, tier in enumerate(tiers):
        number = F.when(F.col(TIER) == tier, F.lit(place)).otherwise(number)
    return number


def train_models(
    data: DataFrame,
    params: ModelParams,
    tiers: bool = True,
    fallback: bool = True,
) -> ChurnModel:
    """Fit all eligible tier models and the global model.

    All routes are prepared and boosted together, see :mod:`ebbtide.operators.boosting`;
    measuring them is one Spark job each, a few at the same time. A tier that cannot be
    measured falls back to the global model; a failing global model raises.
    """
    check_input(data)
    if TIER not in data.columns:
        raise ValueError(f"the training data has no column {TIER}")
    known = with_known_tier(data)
    total, churned = known.agg(F.count("*"), F.sum(LABEL).cast("long")).first()
    # Only tiers with enough rows get a model and travel to the driver.
    stats = {}
    if tiers:
        eligible = tier_eligibility(known, params).where("eligible")
        stats = {r["tier"]: r for r in eligible.collect()}
    names = sorted(stats)
    if fallback and churned in (0, total):
        raise ValueError("the training data holds a single class")
    routes = dict(enumerate(names)) | ({FALLBACK: GLOBAL_ROUTE} if fallback else {})
    fitted = ChurnModel(params)
    if not routes:
        return fitted
    table = stored(known.withColumn(NUMBER, route_number(names)))
    preps = fit_preparations(table, routes)
    vectors = stored(training_vectors(table, preps), NUMBER)
    plans: list[tuple[int, float, int, int]] = []
    for place, tier in enumerate(names):
        r = stats[tier]
        balance = (r["sample_size"] - r["churn_count"]) / r["churn_count"]
        weight = balance * params.weights.get(tier, DEFAULT_WEIGHT)
        plans.append((place, weight, r["sample_size"], r["churn_count"]))
    if fallback:
        plans.append((FALLBACK, (total - churned) / churned, total, churned))

    ensembles = _fitted_trees(
        vectors, preps, {place: weight for place, weight, *_ in plans}, 2 * total, params
    )

    def fit(plan: tuple[int, float, int, int]) -> None:
        place, *figures = plan
        rows = vectors.where(F.col(NUMBER) == place)
        known_parts = (*figures, params, preps[place], ensembles[place])
        if place == FALLBACK:
            fitted.fallback = train_route(rows, GLOBAL_ROUTE, *known_parts)
            return
        tier = names[place]
        try:
            fitted.routes[tier] = train_route(rows, tier, *known_parts)
        except Exception as error:
            log.error("tier %s: %s", tier, error)
            fitted.failures[tier] = str(error)

    with ThreadPoolExecutor(max_workers=max(1, params.parallel_fits)) as pool:
        # One wrapper per route: each holds one set of local properties, and jobs that share
        # a set take each other's execution ids away.
        jobs = [inheritable_thread_target(data.sparkSession)(fit) for _ in plans]
        list(pool.map(lambda job, plan: job(plan), jobs, plans))
    return fitted


def training_metrics(model: ChurnModel, spark: SparkSession) -> DataFrame:
    """AUC on the training rows (no quality claim), size and churn per model."""
    rows = [
        (
            route,
            m.result.auc,
            m.result.sample_size,
            m.result.churn_rate,
            m.result.churn_count,
            m.result.feature_count,
        )
        for route, m in model.named
    ]
    return spark.createDataFrame(
        rows,
        "model string, auc double, sample_size long, churn_rate double, "
        "churn_count long, feature_count int",
    )


def feature_importance(model: ChurnModel, spark: SparkSession, top_n: int = 20) -> DataFrame:
    """The top_n features of each model, most important first."""
    rows = []
    for route, m in model.named:
        pairs = zip(m.preparation.feature_names, m.trees["importance"])
        best = sorted(pairs, key=lambda p: (-p[1], p[0]))[:top_n]
        rows += [(route, place, name, float(v)) for place, (name, v) in enumerate(best, 1)]
    return spark.createDataFrame(
        rows, "model string, place int, feature string, importance double"
    )


def model_summary(model: ChurnModel, spark: SparkSession) -> DataFrame:
    """Counts of models and features in long form."""
    rows = [
        ("model_counts", "tier_specific_models", float(len(model.tiers))),
        ("model_counts", "global_fallback", 1.0 if model.fallback else 0.0),
    ]
    for route, m in model.named:
        r = m.result
        rows += [
            (route, "auc", r.auc),
            (route, "sample_size", float(r.sample_size)),
            (route, "churn_rate", r.churn_rate),
            (route, "churn_count", float(r.churn_count)),
            (route, "feature_count", float(r.feature_count)),
        ]
    return spark.createDataFrame(rows, "entity string, metric string, value double")


def model_comparison(
    data: DataFrame, params: ModelParams, folds: int = 5, trees: int = 20
) -> DataFrame:
    """Cross-validated AUC of three model families on the global features: mean and
    standard deviation over the folds."""
    known = stored(with_known_tier(data))
    prep = fit_preparation(known, GLOBAL_ROUTE)
    vectors = training_vectors(known.withColumn(NUMBER, F.lit(FALLBACK)), {FALLBACK: prep})
    tasks = max(1, math.ceil(known.count() / params.rows_per_task))
    ready = vectors.select(
        array_to_vector("features").alias("features"), F.col(LABEL).cast("double").alias(LABEL)
    )
    frame = pinned(ready.repartition(tasks))
    families = {
        "gradient_boosting": GBTClassifier(labelCol=LABEL, maxIter=trees, seed=params.seed),
        "logistic_regression": LogisticRegression(labelCol=LABEL, maxIter=50),
        "random_forest": RandomForestClassifier(
            labelCol=LABEL, numTrees=trees, seed=params.seed
        ),
    }
    judge = BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC")
    rows = []
    for name, estimator in families.items():
        search = CrossValidator(
            estimator=estimator,
            estimatorParamMaps=ParamGridBuilder().build(),
            evaluator=judge,
            numFolds=folds,
            parallelism=params.parallel_fits,
            seed=params.seed,
        ).fit(frame)
        rows.append((name, float(search.avgMetrics[0]), float(search.stdMetrics[0])))
    return data.sparkSession.createDataFrame(
        rows, "algorithm string, cv_mean_auc double, cv_std_auc double"
    )
