"""Metric tables in long form, quality gate and regression gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from finsieve.constants import MIN_AVERAGE_PRECISION, MIN_RECALL, REGRESSION_TOLERANCES

METRICS = (
    "average_precision", "max_precision", "threshold", "accuracy", "precision", "recall",
    "f1_score", "alerts", "alert_rate_pct", "tp", "fp", "fn", "tn",
)


def metrics_long(metrics: DataFrame, n_test: str | None = None) -> DataFrame:
    """One row per (model, metric) that is known.

    Accuracy, F1, alerts and alert rate are derived when the table lacks them and has
    their parts. A model without a single metric fails the job.
    """
    names = set(metrics.columns)

    def given(name: str) -> Column:
        return F.col(name).cast("double") if name in names else F.lit(None).cast("double")

    tp, fp, fn, tn = (given(c) for c in ("tp", "fp", "fn", "tn"))
    p, r = given("precision"), given("recall")
    total = tp + fp + fn + tn
    derived = {name: given(name) for name in METRICS}
    derived["accuracy"] = F.coalesce(derived["accuracy"], F.when(total > 0, (tp + tn) / total))
    derived["f1_score"] = F.coalesce(derived["f1_score"], F.when(p + r > 0, 2 * p * r / (p + r)))
    derived["alerts"] = F.coalesce(derived["alerts"], tp + fp)
    if n_test:
        derived["alert_rate_pct"] = F.coalesce(
            derived["alert_rate_pct"], F.when(given(n_test) > 0, 100.0 * derived["alerts"] / given(n_test))
        )
    cells = F.filter(
        F.array(*[F.struct(F.lit(m).alias("metric"), c.alias("value")) for m, c in derived.items()]),
        lambda cell: cell["value"].isNotNull(),
    )
    empty = F.raise_error(F.lit("no metrics were found")).cast("array<struct<metric:string,value:double>>")
    return metrics.withColumn("_cells", cells).select(
        "model", F.explode(F.when(F.size("_cells") > 0, F.col("_cells")).otherwise(empty)).alias("c")
    ).select("model", "c.metric", "c.value")


def regression_rows(observed: DataFrame, baseline: DataFrame) -> DataFrame:
    """Observed against baseline for every metric both have; long tables (model, metric, value).

    The tolerance is two-sided: a large improvement also counts as a change.
    """
    pairs = observed.withColumnRenamed("value", "observed").join(
        baseline.select("metric", F.col("value").alias("baseline")), "metric"
    )
    tolerance = F.lit(None).cast("double")
    for name, tol in REGRESSION_TOLERANCES.items():
        tolerance = F.when(F.col("metric") == name, F.lit(tol)).otherwise(tolerance)
    delta = F.col("observed") - F.col("baseline")
    relative = F.when(F.col("baseline") == 0, F.lit(0.0)).otherwise(delta / F.col("baseline"))
    return pairs.select(
        "model", "metric", "baseline", "observed", delta.alias("delta"), relative.alias("relative"),
        tolerance.alias("tolerance"),
    ).withColumn(
        "status",
        F.when(F.col("tolerance").isNull(), F.lit("info"))
        .when(F.abs("relative") <= F.col("tolerance"), F.lit("ok")).otherwise(F.lit("regressed")),
    )


def regression_verdict(rows: DataFrame) -> DataFrame:
    """One row per model with the failing metric names in order."""
    failing = F.array_sort(F.collect_list(F.when(F.col("status") == "regressed", F.col("metric"))))
    return rows.groupBy("model").agg(failing.alias("failing")).withColumn("passed", F.size("failing") == 0)


def quality_gate(metrics: DataFrame, min_ap: float = MIN_AVERAGE_PRECISION,
                 min_recall: float = MIN_RECALL) -> DataFrame:
    """Floors on average precision and on recall at the operating point."""
    ap, recall = F.col("average_precision") >= min_ap, F.col("recall") >= min_recall
    return metrics.select(
        "model", "average_precision", "recall", ap.alias("ap_ok"), recall.alias("recall_ok"),
        (ap & recall).alias("passed"),
    )
