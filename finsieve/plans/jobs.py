"""Whole jobs: train with its gate, and evaluation of a saved run against a baseline."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from finsieve.constants import TARGET
from finsieve.operators import features as ft, gates, models as md, prep, ranking as rk, validation as dq
from finsieve.sources.ledger import read_prepared, write_prepared, write_report


class Trained(NamedTuple):
    model: str
    n_train: int
    n_test: int
    metrics: DataFrame
    passed: bool


class Verdict(NamedTuple):
    metrics: DataFrame
    quality: DataFrame
    regression: DataFrame


def train_job(ledger: DataFrame, path: str, name: str = md.SELECTED, rounds: int = md.BOOSTING_ROUNDS) -> Trained:
    """Validate, build features, split, fit, save, evaluate and gate.

    The split table is written first and read back by fold. The model is saved before it
    is evaluated, so a failing evaluation does not cost the fit.
    """
    spark = ledger.sparkSession
    rows = prep.split_by_hash(ft.build_features(dq.validate_ledger(ledger)))
    write_prepared(rows.select("row_id", *ft.MODEL_FEATURES, TARGET, "split"), f"{path}/prepared")
    manifest = {r.split: r.n for r in prep.split_manifest(read_prepared(spark, f"{path}/prepared")).collect()}
    model = md.fit(read_prepared(spark, f"{path}/prepared", "train"), md.specs(rounds)[name])
    model.write().overwrite().save(f"{path}/model")
    metrics, quality = _evaluate(spark, path, model, name)
    write_report(metrics.join(quality.select("model", "passed"), "model"), f"{path}/report")
    return Trained(name, manifest.get("train", 0), manifest.get("test", 0), metrics, quality.first().passed)


def _evaluate(spark: SparkSession, path: str, model: PipelineModel, name: str) -> tuple[DataFrame, DataFrame]:
    test = read_prepared(spark, f"{path}/prepared", "test")
    metrics = rk.evaluation(md.scored(model, test, name))
    return metrics, gates.quality_gate(metrics)


def evaluate_job(spark: SparkSession, path: str, baseline: DataFrame, name: str = md.SELECTED) -> Verdict:
    """Score the saved run again and compare it with a baseline's metrics row."""
    metrics, quality = _evaluate(spark, path, PipelineModel.load(f"{path}/model"), name)
    rows = gates.regression_rows(gates.metrics_long(metrics), gates.metrics_long(baseline))
    return Verdict(metrics, quality, gates.regression_verdict(rows))
