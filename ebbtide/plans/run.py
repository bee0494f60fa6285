"""The whole analysis as one call: profile, cohorts, labels, features, models,
predictions, report."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from ebbtide.params import ChurnParams, ModelParams
from ebbtide.plans.cohort import cohort_analysis
from ebbtide.plans.features import feature_set, final_dataset
from ebbtide.plans.labels import churn_labels
from ebbtide.plans.profile import churn_stats, explore
from ebbtide.plans.report import churn_report, reloaded_stats
from ebbtide.plans.scoring import NODE_COLUMNS, load_model, predictions, save_model
from ebbtide.plans.stages import Stages
from ebbtide.plans.training import ChurnModel, train_models
from ebbtide.session import stored
from ebbtide.sources.manifest import version_of
from ebbtide.sources.sinks import write_csv, write_parquet
from ebbtide.sources.schemas import PREDICTIONS
from ebbtide.sources.tables import Tables, read_csv


@dataclass
class RunResult:
    exploration: dict[str, DataFrame]
    cohort: DataFrame
    labels: DataFrame
    dataset: DataFrame
    model: ChurnModel
    predictions: DataFrame
    report: DataFrame
    paths: dict[str, str]


def modelling_set(tables: Tables, params: ChurnParams) -> DataFrame:
    labels = churn_labels(tables.order_header, params)
    return final_dataset(labels, feature_set(tables.order_header, tables.order_item, params))


def _model_digest(model: ChurnModel) -> str:
    digest = hashlib.sha256()
    for name, m in model.named:
        p = m.preparation
        digest.update(json.dumps([name, p.medians, p.mode_codes]).encode())
        for column in NODE_COLUMNS:
            digest.update(m.trees[column].tobytes())
    return digest.hexdigest()


def run_key(
    tables: Tables,
    params: ChurnParams,
    model_params: ModelParams,
    model: ChurnModel | None = None,
) -> str | None:
    """What a run is known by: its settings, the files of both tables (paths, lengths and
    times) and a given model. None if a table has no files, as one read by JDBC."""
    spark = tables.order_header.sparkSession
    versions = [
        version_of(spark, t.inputFiles()) for t in (tables.order_header, tables.order_item)
    ]
    if None in versions:
        return None
    given = None if model is None else _model_digest(model)
    parts = [asdict(params), asdict(model_params), *versions, given]
    text = json.dumps(parts, default=str, sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:32]


def run(
    tables: Tables,
    params: ChurnParams,
    model_params: ModelParams,
    output: str | None = None,
    model: ChurnModel | None = None,
    resume: bool = True,
) -> RunResult:
    """Run every step; with ``output`` the predictions, model and report are saved.

    A run with ``output`` that is started again, with the same settings on the same files,
    goes on after its last finished stage (labels, dataset, model, predictions, report); a
    finished one only reads its results. ``resume=False`` begins anew, as do tables that do
    not come from files. ``model`` is used instead of training one.
    """
    spark = tables.order_header.sparkSession
    stages = None
    if output:
        key = run_key(tables, params, model_params, model) if resume else None
        stages = Stages(spark, output, key or uuid.uuid4().hex)

    def kept(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        # Training and scoring read the modelling set many times: keep one written copy.
        return stages.table(name, make) if stages else stored(make())

    def features() -> DataFrame:
        return feature_set(tables.order_header, tables.order_item, params)

    exploration = explore(tables.order_header, tables.order_item, params)
    cohort = cohort_analysis(tables.order_header, params)
    labels = kept("labels", lambda: churn_labels(tables.order_header, params))
    dataset = kept("dataset", lambda: final_dataset(labels, features()))
    paths = {}
    if stages:
        paths["model"] = stages.path(
            "churn_model",
            lambda path: save_model(model or train_models(dataset, model_params), path, spark),
        )
        model = load_model(paths["model"], spark)
        paths["predictions"] = stages.path(
            "churn_predictions", lambda path: write_csv(predictions(dataset, model), path)
        )
        scored = read_csv(spark, paths["predictions"], PREDICTIONS)
    else:
        model = model or train_models(dataset, model_params)
        scored = predictions(dataset, model)
    report = churn_report(cohort, churn_stats(labels), model, dataset)
    if stages:
        paths["report"] = stages.path("churn_report", lambda path: write_parquet(report, path))
        report = spark.read.schema(report.schema).parquet(paths["report"])
    return RunResult(exploration, cohort, labels, dataset, model, scored, report, paths)


def regenerate_report(
    spark: SparkSession,
    tables: Tables,
    params: ChurnParams,
    model_path: str,
    predictions_path: str,
) -> DataFrame:
    """The report from a saved model and saved predictions."""
    saved = read_csv(spark, predictions_path, PREDICTIONS)
    cohort = cohort_analysis(tables.order_header, params)
    return churn_report(cohort, reloaded_stats(saved), load_model(model_path, spark), saved)
