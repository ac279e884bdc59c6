"""Written monitoring policies as tables: sustained drift and retraining decisions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from finsieve.constants import DRIFT_WINDOWS, PSI_SIGNIFICANT
from finsieve.operators.drift import Profile, drift_report
from finsieve.operators.gates import regression_verdict


#: Written thresholds have no figure for a material change of the alert rate or for operational health; these are ours.
ALERT_SHIFT_PP = 1.0
ERROR_RATE = 0.02
QUALITY_METRICS = ("average_precision", "precision", "recall", "f1_score")


def operational_health(requests: DataFrame, window: Column, max_error_rate: float = ERROR_RATE,
                       max_p95: float | None = None) -> DataFrame:
    """(window_start, unhealthy) from requests (status_class, latency_ms): too many server errors, or a slow 95th percentile."""
    errors = F.avg((F.col("status_class") == "5xx").cast("double")) >= max_error_rate
    slow = F.lit(False) if max_p95 is None else F.percentile("latency_ms", 0.95) >= max_p95
    return requests.groupBy(window.alias("window_start")).agg((errors | slow).alias("unhealthy"))


def window_conditions(profile: Profile, current: DataFrame, window: str = "window_start", score: str = "score",
                      threshold: float | None = None, reference_alert_rate: float | None = None,
                      operations: DataFrame | None = None, controlled: Column | None = None) -> DataFrame:
    """Investigation conditions per monitoring window.

    Prediction drift, any input with significant drift, several inputs with at least
    moderate drift, an alert rate that moved by ``ALERT_SHIFT_PP`` points from the
    reference, or unhealthy ``operations`` (see ``operational_health``). Rows that
    ``controlled`` marks, such as synthetic or smoke-test traffic, are left out.
    """
    if controlled is not None:
        current = current.filter(~F.coalesce(controlled, F.lit(False)))
    report = drift_report(profile, current, [window])
    is_score = F.col("feature") == score
    strong = F.col("psi") >= PSI_SIGNIFICANT
    found = report.groupBy(window).agg(
        F.coalesce(F.bool_or(is_score & strong), F.lit(False)).alias("prediction_drift"),
        F.coalesce(F.bool_or(~is_score & strong), F.lit(False)).alias("input_drift"),
        (F.count_if(~is_score & (F.col("signal") == "moderate")) >= 2).alias("several_moderate"),
    )
    if reference_alert_rate is not None:
        rate = F.avg((F.col(score) >= threshold).cast("double"))
        moved = F.abs(100.0 * (rate - reference_alert_rate)) >= ALERT_SHIFT_PP
        found = found.join(current.groupBy(window).agg(moved.alias("alert_shift")), window, "left")
    else:
        found = found.withColumn("alert_shift", F.lit(False))
    if operations is not None:
        found = found.join(operations.select(F.col("window_start").alias(window), "unhealthy"), window, "left")
    else:
        found = found.withColumn("unhealthy", F.lit(False))
    names = ("prediction_drift", "input_drift", "several_moderate", "alert_shift", "unhealthy")
    found = found.withColumns({n: F.coalesce(n, F.lit(False)) for n in names})
    return found.withColumn("condition", reduce(Column.__or__, [F.col(n) for n in names]))


def persistence(conditions: DataFrame, window: str = "window_start", needed: int = DRIFT_WINDOWS,
                every: str = "1 day") -> DataFrame:
    """Add ``streak``, the run length so far, and ``investigate`` once it is long enough.

    A run ends where the condition fails and where a window is missing: windows follow
    each other ``every`` so often. One row per monitoring window, so the ordered window
    runs on a calendar-sized table.
    """
    order = Window.orderBy(window)
    follows = F.lag(window).over(order) + F.expr(f"interval {every}") == F.col(window)
    broken = ~F.col("condition") | ~F.coalesce(follows, F.lit(False))
    marked = conditions.withColumn("_broken", broken.cast("int"))
    runs = marked.withColumn("_run", F.sum("_broken").over(order))
    streak = F.sum(F.col("condition").cast("long")).over(Window.partitionBy("_run").orderBy(window))
    return runs.withColumn("streak", streak).withColumn("investigate", F.col("streak") >= needed).drop("_run", "_broken")


def degraded(regression: DataFrame) -> DataFrame:
    """(model, degraded): some quality metric fell below the baseline by more than its tolerance. A gain is no loss."""
    lost = F.col("metric").isin(*QUALITY_METRICS) & (F.col("relative") < -F.col("tolerance"))
    return regression.groupBy("model").agg(F.coalesce(F.bool_or(lost), F.lit(False)).alias("degraded"))


def retrain_decision(persisted: DataFrame, quality: DataFrame, regression: DataFrame, labels: DataFrame,
                     min_labels: int) -> DataFrame:
    """Eligibility and promotion per model.

    A retraining candidate needs a sustained signal, enough labels, and either lost
    quality or a changed population: significant input drift while an investigation is
    open. It is promoted only when both gates pass. ``labels`` is (model, n_labels),
    ``quality`` has ``passed`` per model, and ``regression`` the rows of the regression gate.
    """
    open_ = persisted.agg(
        F.coalesce(F.bool_or("investigate"), F.lit(False)).alias("s"),
        F.coalesce(F.bool_or(F.col("investigate") & F.col("input_drift")), F.lit(False)).alias("p"),
    ).first()
    rows = (
        quality.select("model", F.col("passed").alias("quality_ok"))
        .join(regression_verdict(regression).select("model", F.col("passed").alias("regression_ok")), "model")
        .join(degraded(regression), "model")
        .join(labels, "model")
    )
    eligible = F.col("drift_sustained") & F.col("labels_ok") & (F.col("degraded") | F.col("population_changed"))
    return rows.select(
        "model", F.lit(bool(open_.s)).alias("drift_sustained"), F.lit(bool(open_.p)).alias("population_changed"),
        (F.col("n_labels") >= min_labels).alias("labels_ok"), "quality_ok", "regression_ok", "degraded",
    ).withColumns({"retrain_eligible": eligible, "promote": F.col("quality_ok") & F.col("regression_ok")})
