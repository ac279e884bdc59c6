"""Shapley attribution over the raw model features.

For a score that is a sum of per-feature terms the exact values are each term minus
its mean over the background, so the whole table is explained in one pass. Boosted trees
are explained from their own training counts (``tree_attribution``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from finsieve.constants import MODEL_FEATURES
from finsieve.operators.ordered import exact_quantiles


def additive_cells(df: DataFrame, terms: dict[str, Column], background: DataFrame,
                   keep: Sequence[str] = ("row_id",)) -> DataFrame:
    """(keep, cells, base): each row's (feature, phi) as one array, for a score that is the sum of ``terms``."""
    means = background.agg(*[F.avg(t).alias(f) for f, t in terms.items()]).first()
    cells = F.array(*[
        F.struct(F.lit(f).alias("feature"), (t - F.lit(float(means[f]))).alias("phi")) for f, t in terms.items()
    ])
    return df.select(*keep, cells.alias("cells"), F.lit(float(sum(means))).alias("base"))


def additive_attribution(df: DataFrame, terms: dict[str, Column], background: DataFrame,
                         keep: Sequence[str] = ("row_id",)) -> DataFrame:
    """Long rows (keep, feature, phi, base) for a score that is the sum of ``terms``."""
    rows = additive_cells(df, terms, background, keep)
    return rows.select(*keep, F.explode("cells").alias("c"), "base").select(*keep, "c.feature", "c.phi", "base")


class NoMarginError(TypeError):
    """The model has no log-odds."""


def margin(model: Transformer) -> Callable[[DataFrame], DataFrame]:
    """Add ``margin``, the log-odds of a boosted or logistic pipeline, from its raw prediction.

    Raw predictions stay finite where a probability rounds to 0 or 1. A boosted model's
    probability is the logistic function of twice its raw prediction. Other models,
    such as forests, whose votes reach 0 and 1, are refused.
    """
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    if isinstance(last, GBTClassificationModel):
        factor = 2.0
    elif isinstance(last, LogisticRegressionModel):
        factor = 1.0
    else:
        raise NoMarginError(f"{type(last).__name__} has no log-odds")

    def add(df: DataFrame) -> DataFrame:
        return model.transform(df).withColumn("margin", F.lit(factor) * vector_to_array("rawPrediction")[1])
    return add


def to_long(wide: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"phi_{f}").alias("phi")) for f in features])
    return wide.select("row_id", "base", F.explode(cells).alias("c")).select("row_id", "c.feature", "c.phi", "base")


def additivity(wide: DataFrame, features: Sequence[str] = MODEL_FEATURES, tolerance: float = 1e-4) -> DataFrame:
    """Largest gap between base plus contributions and the margin."""
    total = F.col("base")
    for f in features:
        total = total + F.col(f"phi_{f}")
    return wide.agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.abs(total - F.col("margin"))).alias("max_abs_error")
    ).withColumn("within_tolerance", F.col("max_abs_error") <= tolerance)


def margin_checks(wide: DataFrame, reference: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """sigmoid(margin) against stored scores (row_id, score): stale scores show as a gap."""
    gap = F.abs(1 / (1 + F.exp(-F.col("margin"))) - F.col("score"))
    return wide.join(reference.select("row_id", "score"), "row_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(gap).alias("max_abs_error")
    ).withColumn("within_tolerance", F.col("max_abs_error") <= tolerance)


def global_importance(long: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    return (
        long.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))
        .orderBy(F.desc("mean_abs_phi"), "feature")
    )


def direction_summary(rows: DataFrame, values: dict[str, Column], phis: dict[str, Column]) -> DataFrame:
    """Mean contribution at low or absent against high or present values per feature.

    ``values`` and ``phis`` are columns over ``rows`` by feature. A feature with values in
    {0, 1} only is compared by presence, any other by its outer quartiles. The rows stay
    wide: one pass for the quartiles, whose few numbers become literals, and one for the
    conditional means.
    """
    names = list(values)
    long = rows.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), values[f].cast("double").alias("value")) for f in names
    ])))
    quartiles = {r.feature: r.quantiles for r in exact_quantiles(long, ["feature"], "value", (0.25, 0.75)).collect()}
    parts = []
    for f in names:
        value, phi = values[f].cast("double"), phis[f]
        low, high = quartiles.get(f, (None, None))
        at_most, at_least = value <= F.lit(low).cast("double"), value >= F.lit(high).cast("double")
        parts.append(F.struct(
            F.lit(f).alias("feature"), F.bool_and(value.isin(0.0, 1.0)).alias("binary"),
            F.avg(F.when(value == 0, phi)).alias("absent"), F.avg(F.when(value == 1, phi)).alias("present"),
            F.avg(F.when(at_most, phi)).alias("low"), F.avg(F.when(at_least, phi)).alias("high"),
            F.avg(F.abs(phi)).alias("mean_abs_phi"),
        ).alias(f))
    found = rows.agg(*parts).select(F.inline(F.array(*[F.col(f"`{f}`") for f in names])))
    kind = F.when(F.col("binary"), F.lit("binary")).otherwise(F.lit("numeric"))
    low = F.when(F.col("binary"), F.col("absent")).otherwise(F.col("low"))
    high = F.when(F.col("binary"), F.col("present")).otherwise(F.col("high"))
    diff = F.col("high_mean") - F.col("low_mean")
    return found.select("feature", kind.alias("kind"), low.alias("low_mean"), high.alias("high_mean"), "mean_abs_phi").withColumns({
        "high_minus_low": diff,
        "direction": F.when(diff > 0, F.lit("increases")).when(diff < 0, F.lit("decreases")).otherwise(F.lit("none")),
    }).orderBy(F.desc("mean_abs_phi"), "feature")


def top_contributions(cells: DataFrame, keys: Sequence[str] = ("row_id",), top: int = 3) -> DataFrame:
    """Per row the strongest contributions on each side, by absolute size; ties go to the first feature by name.

    ``cells`` is (keys, cells) as ``additive_cells`` gives it. A row's features are sorted
    inside the row, so nothing is shuffled.
    """
    ranked = F.array_sort(F.transform("cells", lambda c: F.struct((-F.abs(c["phi"])).alias("k"), c["feature"].alias("feature"), c["phi"].alias("phi"))))

    def side(name: str, keep: Callable[[Column], Column]) -> Column:
        chosen = F.slice(F.filter(ranked, lambda c: keep(c["phi"])), 1, top)
        return F.transform(chosen, lambda c, i: F.struct(
            F.lit(name).alias("effect"), (i + 1).cast("long").alias("place"), c["feature"].alias("feature"), c["phi"].alias("phi")
        ))
    both = F.concat(side("increases", lambda p: p > 0), side("decreases", lambda p: p < 0))
    return cells.select(*keys, F.inline(both))
