"""Routed scoring, final predictions, and saved models."""

from __future__ import annotations

import json
import logging
from dataclasses import asdict
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.scalars import predicted_class, risk_segment
from ebbtide.operators.ensembles import ensemble_probability
from ebbtide.params import GLOBAL_ROUTE, TIER, BoostSpec, ModelParams
from ebbtide.plans.prepare import (
    FALLBACK,
    NUMBER,
    Preparation,
    check_input,
    route_vectors,
    with_filled_days,
    with_known_tier,
)
from ebbtide.plans.training import (
    LABEL,
    ChurnModel,
    RouteModel,
    RouteResult,
    route_number,
)

log = logging.getLogger(__name__)
NODE_COLUMNS = ("feature", "limit", "left", "right", "value")


def score_members(df: DataFrame, model: ChurnModel, on_error: str = "raise") -> DataFrame:
    """Churn probability per (member, tier), from the tier's own model or the fallback.

    Gaps are filled once for all routes, each tier on its own. Then one plan prepares and
    scores the rows of all routes: every row gets the features of its own route, and the
    models, as flat arrays, are with every task. With ``on_error="neutral"`` a route that
    cannot be prepared scores 0.5.
    """
    check_input(df)
    has_tier = TIER in df.columns
    known = with_known_tier(df) if has_tier else df
    keep = [c for c in ("member_id", TIER, LABEL) if c in known.columns]
    own = model.tiers if has_tier else []
    known = with_filled_days(known, [TIER] if has_tier else [])
    known = known.withColumn(NUMBER, route_number(own))
    fitted = {place: model.routes[tier] for place, tier in enumerate(own)}
    fitted[FALLBACK] = model.fallback
    usable: dict[int, RouteModel] = {}
    for number, route in fitted.items():
        try:
            if route is None:
                raise ValueError("no global model")
            if on_error == "neutral":
                # Analysis alone tells whether the columns will do.
                route_vectors(known, {number: route.preparation}, keep)
        except Exception as error:
            if on_error != "neutral":
                raise
            log.error("route %s scored as neutral: %s", number, error)
            continue
        usable[number] = route
    number = F.col(NUMBER)
    chance = F.lit(0.5)
    if usable:
        known = route_vectors(known, {n: r.preparation for n, r in usable.items()}, keep)
        trees = {n: r.trees for n, r in usable.items()}
        found = ensemble_probability(df.sparkSession, trees, number, F.col("features"))
        chance = F.when(number.isin(list(usable)), found).otherwise(chance)
    own_model = F.when(number == FALLBACK, "global_fallback").otherwise("tier_specific")
    used = F.when(~number.isin(list(usable)), "default_fallback").otherwise(own_model)
    return known.select(
        *keep,
        chance.alias("churn_probability"),
        used.alias("model_used"),
        (F.col(TIER) if has_tier else F.lit(GLOBAL_ROUTE)).alias("prediction_tier"),
    )


def finalised(scored: DataFrame) -> DataFrame:
    """Actual and predicted class, probability and risk band of scored rows.

    The label travels with each (member, tier) row through scoring, so no join back
    is needed and a member with several tiers is not multiplied.
    """
    return scored.select(
        "member_id",
        TIER,
        F.col(LABEL).cast("int").alias("actual_churn"),
        predicted_class(F.col("churn_probability")).alias("predicted_churn"),
        "churn_probability",
        risk_segment(F.col("churn_probability")).alias("risk_segment"),
    )


def predictions(data: DataFrame, model: ChurnModel) -> DataFrame:
    return finalised(score_members(data, model))


def prediction_join_fanout(data: DataFrame, scored: DataFrame) -> DataFrame:
    """Actuals joined with scores on the member alone: a member with k tiers gives k*k
    rows. Kept for comparison with :func:`finalised`."""
    actual = data.select(
        F.col("member_id").alias("_member"), F.col(LABEL).alias("actual_churn")
    )
    return actual.join(
        scored.select("member_id", "churn_probability"),
        F.col("_member").eqNullSafe(F.col("member_id")),
    ).select("member_id", "actual_churn", "churn_probability")


def _node_table(number: int, trees: dict) -> pa.Table:
    count = len(trees["value"])
    root = np.zeros(count, dtype=bool)
    root[trees["roots"]] = True
    columns = {c: trees[c] for c in NODE_COLUMNS}
    return pa.table(
        {
            "number": np.full(count, number, dtype=np.int32),
            "node": np.arange(count, dtype=np.int32),
            "root": root,
            **columns,
        }
    )


def _loaded_trees(nodes: pa.Table, number: int, note: dict) -> dict:
    own = nodes.filter(pc.equal(nodes["number"], number)).sort_by("node")
    trees = {c: own[c].to_numpy() for c in NODE_COLUMNS}
    trees["roots"] = np.flatnonzero(own["root"].to_numpy()).astype(np.int32)
    return trees | {"depth": note["depth"], "importance": np.array(note["importance"])}


def save_model(model: ChurnModel, folder: str, spark: SparkSession) -> str:
    """Models, label codes and metadata in one directory."""
    parts, trees = [], []
    notes = {"params": asdict(model.params), "failures": model.failures, "models": []}
    for number, (name, m) in enumerate(model.named):
        trees.append(_node_table(number, m.trees))
        p = m.preparation
        if p.codes is not None:
            parts.append(p.codes.withColumn("number", F.lit(number)))
        notes["models"].append(
            {
                "tier": None if m is model.fallback else name,
                "numeric": p.numeric,
                "categorical": p.categorical,
                "medians": p.medians,
                "mode_codes": p.mode_codes,
                "joined": p.codes is not None,
                "depth": m.trees["depth"],
                "importance": m.trees["importance"].tolist(),
                "result": asdict(m.result),
            }
        )
    if parts:
        reduce(DataFrame.unionByName, parts).write.partitionBy("number").parquet(
            f"{folder}/codes"
        )
    if trees:
        # Nodes of all models: bounded by the boosting settings, not by the rows.
        nodes = spark.createDataFrame(pa.concat_tables(trees))
        nodes.coalesce(1).write.parquet(f"{folder}/trees")
    text = json.dumps(notes)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(
        f"{folder}/metadata"
    )
    return folder


def _loaded_params(saved: dict) -> ModelParams:
    specs = {route: BoostSpec(**s) for route, s in saved["specs"].items()}
    return ModelParams(**{**saved, "specs": specs, "other": BoostSpec(**saved["other"])})


def load_model(folder: str, spark: SparkSession) -> ChurnModel:
    notes = json.loads(spark.read.text(f"{folder}/metadata").first()["value"])
    model = ChurnModel(_loaded_params(notes["params"]), failures=notes["failures"])
    shared = None
    if any(n["joined"] for n in notes["models"]):
        last = len(notes["models"]) - 1 if notes["models"][-1]["tier"] is None else None
        place = F.when(F.col("number") == last, FALLBACK).otherwise(F.col("number"))
        shared = (
            spark.read.schema("column string, value string, code double, number int")
            .parquet(f"{folder}/codes")
            .select(place.alias(NUMBER), "column", "value", "code")
        )
    nodes = spark.read.parquet(f"{folder}/trees").toArrow() if notes["models"] else None
    for number, n in enumerate(notes["models"]):
        at = FALLBACK if n["tier"] is None else number
        codes = shared.where(F.col(NUMBER) == at).drop(NUMBER) if n["joined"] else None
        route = GLOBAL_ROUTE if n["tier"] is None else n["tier"]
        prep = Preparation(
            route,
            n["numeric"],
            n["categorical"],
            n["medians"],
            n["mode_codes"],
            codes,
            at,
            shared if n["joined"] else None,
        )
        trees = _loaded_trees(nodes, number, n)
        loaded = RouteModel(route, prep, trees, RouteResult(**n["result"]))
        if n["tier"] is None:
            model.fallback = loaded
        else:
            model.routes[n["tier"]] = loaded
    return model
