"""Classifiers on pyspark.ml, batch scoring and score parity."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from finsieve.constants import MODEL_FEATURES, MODEL_VERSION, NUMERIC_FEATURES, SEED, SERVING_THRESHOLD, TARGET
from finsieve.operators.prep import CELL_ROWS, add_weight, bin_cuts, binning, cells, preprocessing, undersample
from finsieve.operators.ranking import average_precision
from finsieve.session import cut_lineage, stage

BOOSTING_ROUNDS = 200
#: Rows that stand for a cell of more rows in a forest: its trees draw a quarter and ask for 20 of them in a node.
FOREST_ROWS = 160


class MissingFeatureError(ValueError):
    """A scoring input lacks model features; the message names them."""


class Spec(NamedTuple):
    """How a model is trained: estimator, class weighting, linear scaling, undersampling, on rows or on cells of equal bins, of so many rows at most."""

    estimator: Callable[[int, bool], object]
    weight: str | None = None
    scale: bool = False
    under: bool = False
    cells: int = 0


def _logistic(rows: int, weighted: bool) -> LogisticRegression:
    # Balanced weights sum to the row count, so the penalty is 1 / (C * rows) with C = 1.
    model = LogisticRegression(
        labelCol=TARGET, maxIter=1000, regParam=1.0 / max(rows, 1), elasticNetParam=0.0, standardization=False,
        tol=1e-4,
    )
    return model.setWeightCol("weight") if weighted else model


def _forest(rows: int, weighted: bool) -> RandomForestClassifier:
    model = RandomForestClassifier(
        labelCol=TARGET, numTrees=80, maxDepth=12, minInstancesPerNode=20, featureSubsetStrategy="sqrt",
        subsamplingRate=0.25, seed=SEED,
    )
    return model.setWeightCol("weight") if weighted else model


def boosted(rounds: int = BOOSTING_ROUNDS) -> Callable[[int, bool], GBTClassifier]:
    def build(rows: int, weighted: bool) -> GBTClassifier:
        model = GBTClassifier(
            labelCol=TARGET, maxIter=rounds, maxDepth=6, stepSize=0.08, minInstancesPerNode=10,
            subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=SEED,
        )
        return model.setWeightCol("weight") if weighted else model
    return build


def specs(rounds: int = BOOSTING_ROUNDS) -> dict[str, Spec]:
    """Every trained model, in comparison order."""
    return {
        "logistic_balanced": Spec(_logistic, weight="balanced", scale=True),
        "logistic_plain": Spec(_logistic, scale=True),
        "random_forest": Spec(_forest, weight="balanced", cells=FOREST_ROWS),
        "boosted_weighted": Spec(boosted(rounds), weight="scale_pos", cells=CELL_ROWS),
        "boosted_undersampled": Spec(boosted(rounds), under=True, cells=CELL_ROWS),
    }


SELECTED = "boosted_weighted"


def fit(train: DataFrame, spec: Spec, drop: Sequence[str] = ()) -> PipelineModel:
    """Fit preprocessing and classifier on the train fold, after any undersampling.

    Two hundred rounds of boosting pass over their table some thousand times, and a forest keeps a count for each row
    and tree, so their table holds cells and not rows.
    """
    if spec.under:
        train = undersample(train)
    if spec.weight:
        train = add_weight(train, spec.weight)
    columns = [c for c in MODEL_FEATURES if c not in drop]
    keep = [*columns, TARGET] + (["weight"] if spec.weight else [])
    train = train.select(*keep)
    if spec.cells:
        weight = "weight" if spec.weight else None
        numbers = [c for c in NUMERIC_FEATURES if c in columns]
        binned = binning(bin_cuts(train, numbers, weight))
        table = cells(binned.transform(train), [*(f"{c}_bin" if c in numbers else c for c in columns), TARGET], weight, spec.cells)
        prepared = preprocessing(drop=drop, binned=True).fit(table)
        cut_lineage(train.sparkSession)
        classifier = spec.estimator(0, True).fit(prepared.transform(table))
        return PipelineModel(stages=[binned, *prepared.stages, classifier])
    prepared = preprocessing(spec.scale, drop).fit(train)
    rows = train.count() if spec.scale else 0
    classifier = spec.estimator(rows, spec.weight is not None).fit(prepared.transform(train))
    return PipelineModel(stages=[*prepared.stages, classifier])


def _probability() -> Column:
    return vector_to_array("probability")[1]


def _with_score(model: Transformer, df: DataFrame) -> DataFrame:
    """Add ``_score``. A model over bins sees nothing but cells, so each cell that occurs is scored once and its rows look it up.

    Hundreds of trees then cost as much as there are cells, however many rows they hold.
    """
    if df.isStreaming or not (isinstance(model, PipelineModel) and isinstance(model.stages[0], SQLTransformer)):
        return model.transform(df).withColumn("_score", _probability())
    binned = model.stages[0].transform(df)
    inputs = next(s for s in reversed(model.stages) if isinstance(s, VectorAssembler)).getInputCols()
    keys = [c.removesuffix("_oh") for c in inputs]
    scores = PipelineModel(stages=model.stages[1:]).transform(binned.select(*keys).distinct())
    # Written, so that Spark knows the table's size when it picks the join.
    scores = stage(scores.select(*[F.col(k).alias(f"_k_{k}") for k in keys], _probability().alias("_score")), "cell-scores")
    same = [binned[k].eqNullSafe(scores[f"_k_{k}"]) for k in keys]
    return binned.join(scores, same, "left").select(*df.columns, "_score")


def require_features(df: DataFrame, needed: Sequence[str] = MODEL_FEATURES) -> None:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise MissingFeatureError(f"missing model features: {', '.join(missing)}")


def with_contract(df: DataFrame, score: Column, threshold: float = SERVING_THRESHOLD,
                  version: str = MODEL_VERSION) -> DataFrame:
    """Add the output contract: risk_score, is_alert, threshold, model_version."""
    return df.withColumn("risk_score", score).withColumns({
        "is_alert": F.col("risk_score") >= F.lit(threshold),
        "threshold": F.lit(threshold),
        "model_version": F.lit(version),
    })


OUTPUT_CONTRACT = ("risk_score", "is_alert", "threshold", "model_version")


def score_batch(model: Transformer, df: DataFrame, threshold: float = SERVING_THRESHOLD,
                version: str = MODEL_VERSION, keep: Sequence[str] = ("row_id",)) -> DataFrame:
    """Features in, contract out, next to ``keep``. Extra columns are ignored."""
    require_features(df)
    source = df.select(*dict.fromkeys([*keep, *MODEL_FEATURES]))
    return with_contract(_with_score(model, source), F.col("_score"), threshold, version).select(*keep, *OUTPUT_CONTRACT)


def scored(model: Transformer, df: DataFrame, name: str) -> DataFrame:
    """Evaluation rows (model, row_id, label, score)."""
    return _with_score(model, df).select(F.lit(name).alias("model"), "row_id", F.col(TARGET).alias("label"), F.col("_score").alias("score"))


def majority_scored(df: DataFrame, name: str = "majority") -> DataFrame:
    """The majority baseline never suspects anything."""
    return df.select(F.lit(name).alias("model"), "row_id", F.col(TARGET).alias("label"), F.lit(0.0).alias("score"))


def score_parity(left: DataFrame, right: DataFrame, tolerance: float) -> DataFrame:
    """Largest difference between two scored tables over row_id, and rows only one has."""
    both = left.select("row_id", F.col("risk_score").alias("a")).join(
        right.select("row_id", F.col("risk_score").alias("b")), "row_id", "full_outer"
    )
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("n_unmatched"),
        F.max(F.abs(F.col("a") - F.col("b"))).alias("max_abs_diff"),
    ).withColumn(
        "within_tolerance", (F.col("n_unmatched") == 0) & (F.coalesce("max_abs_diff", F.lit(0.0)) <= tolerance)
    )


def ablation(full: DataFrame, less: DataFrame, dropped: str) -> DataFrame:
    """(dropped, average_precision, without, difference): what two scored tables of one model, the second fitted without a feature, differ by."""
    both = full.withColumn("model", F.lit("full")).unionByName(less.withColumn("model", F.lit("less")))
    ap = average_precision(both)
    of = lambda m: F.max(F.when(F.col("model") == m, F.col("average_precision")))
    out = ap.agg(of("full").alias("average_precision"), of("less").alias("without"))
    return out.select(F.lit(dropped).alias("dropped"), "average_precision", "without", (F.col("without") - F.col("average_precision")).alias("difference"))
