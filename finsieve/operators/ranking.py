"""Ranking evaluation over scored rows ``(model, row_id, label, score)``.

All models are evaluated in one job with ``model`` as a key. Scores are first
aggregated to one row per (model, score); every curve is a running sum over those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from finsieve.constants import ALERT_BUDGETS, PRECISION_TARGET, PRECISION_TARGETS
from finsieve.operators.ordered import ROWS_PER_TASK, row_rank, running_sums
from finsieve.session import stage


def finite_score(score: str = "score") -> Column:
    """The score, failing the job when one is missing or not finite."""
    s = F.col(score)
    bad = s.isNull() | F.isnan(s) | (F.abs(s) == float("inf"))
    return F.when(bad, F.raise_error(F.lit("scores must be finite")).cast("double")).otherwise(s)


def single_precision(scored: DataFrame) -> DataFrame:
    """Scores rounded to 32 bits, which decides ties in budgets and precision targets."""
    return scored.withColumn("score", F.col("score").cast("float").cast("double"))


def ranked_scores(scored: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(model, score, n, tp, cum_n, cum_tp, n_total, p_total), running from the top score down."""
    counts = scored.select("model", finite_score().alias("score"), "label").groupBy("model", "score").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("long")).alias("tp")
    )
    return running_sums(
        counts, ["model"], [("score", "desc")], {"cum_n": "n", "cum_tp": "tp"},
        {"n_total": "n", "p_total": "tp"}, rows_per_task,
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def _recall(tp: Column, positives: Column) -> Column:
    """Recall along the curve; with no positives nothing is missed."""
    return F.when(positives == 0, F.lit(1.0)).otherwise(tp / positives)


def pr_curve(scored: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """One point per distinct score; the closing (1, 0) point has no threshold and is absent."""
    return _curve(ranked_scores(scored, rows_per_task))


def _curve(ranked: DataFrame) -> DataFrame:
    return ranked.select(
        "model", F.col("score").alias("threshold"),
        (F.col("cum_tp") / F.col("cum_n")).alias("precision"),
        _recall(F.col("cum_tp"), F.col("p_total")).alias("recall"),
        "cum_n", "cum_tp", "n_total", "p_total", "tp",
    )


def average_precision(scored: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Step-wise average precision over distinct scores, and the best precision on the curve."""
    return curve_summary(pr_curve(scored, rows_per_task))


def curve_summary(curve: DataFrame) -> DataFrame:
    step = _ratio(F.col("tp"), F.col("p_total")) * F.col("precision")
    return curve.groupBy("model").agg(
        F.sum(step).alias("average_precision"), F.max("precision").alias("max_precision")
    )


def _metrics(tp: Column, alerts: Column, n: Column, p: Column) -> dict[str, Column]:
    """Counts and ratios at a cut; an empty denominator gives 0."""
    precision, recall = _ratio(tp, alerts), _ratio(tp, p)
    return {
        "tn": n - p - alerts + tp, "fp": alerts - tp, "fn": p - tp, "tp": tp,
        "accuracy": _ratio(n - p - alerts + 2 * tp, n),
        "precision": precision, "recall": recall,
        "f1_score": _ratio(2 * precision * recall, precision + recall),
        "alerts": alerts, "alert_rate_pct": _ratio(100.0 * alerts, n),
    }


def operating_point(scored: DataFrame, target: float = PRECISION_TARGET,
                    rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The smallest threshold with precision >= target and the metrics there.

    When no threshold gets there, the one with the best precision is used, the
    smallest on ties, and ``reached`` is false.
    """
    return _pick_operating_point(_curve(ranked_scores(scored, rows_per_task)), target)


def _pick_operating_point(curve: DataFrame, target: float) -> DataFrame:
    point = F.struct("threshold", "cum_n", "cum_tp")
    picked = curve.groupBy("model").agg(
        F.min_by(point, F.when(F.col("precision") >= target, F.col("threshold"))).alias("hit"),
        F.max_by(point, F.struct("precision", -F.col("threshold"))).alias("best"),
        F.max("n_total").alias("n"), F.max("p_total").alias("p"),
    ).withColumn("at", F.coalesce("hit", "best"))
    metrics = _metrics(F.col("at.cum_tp"), F.col("at.cum_n"), F.col("n"), F.col("p"))
    return picked.select(
        "model", F.lit(target).alias("precision_target"), F.col("hit").isNotNull().alias("reached"),
        F.col("at.threshold").alias("threshold"), *[c.alias(name) for name, c in metrics.items()],
    )


def evaluation(scored: DataFrame, target: float = PRECISION_TARGET,
               rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Average precision, best precision and the operating point, one row per model."""
    curve = _curve(ranked_scores(scored, rows_per_task))
    return curve_summary(curve).join(_pick_operating_point(curve, target), "model")


def fixed_precision(scored: DataFrame, targets: Sequence[float] = PRECISION_TARGETS,
                    rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Per (model, target): the most recall with at least that precision.

    Recall grows as the threshold falls, so that is the smallest valid threshold. A
    target out of reach keeps its row with null metrics and no alerts.
    """
    curve = _curve(ranked_scores(single_precision(scored), rows_per_task))
    # The array literal carries the targets through one aggregate instead of a join.
    point = F.struct("threshold", "cum_n", "cum_tp")

    def best(t: float) -> Column:
        return F.min_by(point, F.when(F.col("precision") >= t, F.col("threshold")))

    picked = curve.groupBy("model").agg(
        F.array(*[F.struct(F.lit(t).alias("precision_target"), best(t).alias("at")) for t in targets]).alias("rows"),
        F.max("n_total").alias("n"), F.max("p_total").alias("p"),
    ).select("model", "n", "p", F.explode("rows").alias("r")).select("model", "n", "p", "r.*")
    tp, alerts = F.coalesce("at.cum_tp", F.lit(0)), F.coalesce("at.cum_n", F.lit(0))
    found = F.col("at").isNotNull()
    return picked.select(
        "model", "precision_target", F.col("at.threshold").alias("threshold"),
        F.when(found, _ratio(tp, alerts)).alias("precision"),
        F.when(found, _ratio(tp, F.col("p"))).alias("recall"),
        alerts.alias("alerts"), _ratio(100.0 * alerts, F.col("n")).alias("alert_rate_pct"),
        tp.alias("tp"), (alerts - tp).alias("fp"), (F.col("p") - tp).alias("fn"),
        (F.col("n") - F.col("p") - alerts + tp).alias("tn"),
        F.when(found & (tp == 0), F.lit(float("inf"))).when(found, alerts / tp).alias("alerts_per_tp"),
    )


def alert_budgets(scored: DataFrame, budgets: Sequence[float] = ALERT_BUDGETS,
                  rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Exact top-k at each budget rate; among equal scores the last row_id goes first.

    Whole scores above the cut come from the running counts. Only rows that share the
    boundary score are ranked one by one.
    """
    if any(not 0 < b <= 1 for b in budgets):
        raise ValueError("alert budgets must lie in (0, 1]")
    scored = single_precision(scored)
    ranked = ranked_scores(scored, rows_per_task)
    here = F.struct("score", "n", "tp", "cum_n", "cum_tp")

    def cut(rate: float) -> Column:
        k = F.greatest(F.lit(1), F.ceil(F.col("n_total") * F.lit(rate))).cast("long")
        on_boundary = (F.col("cum_n") >= k) & (F.col("cum_n") - F.col("n") < k)
        return F.struct(
            F.lit(rate).alias("budget"), F.max(k).alias("k"), F.max(F.when(on_boundary, here)).alias("at")
        )

    cuts = ranked.groupBy("model").agg(
        F.array(*[cut(b) for b in budgets]).alias("cuts"),
        F.max("n_total").alias("n_rows"), F.max("p_total").alias("p_rows"),
    ).select("model", "n_rows", "p_rows", F.explode("cuts").alias("c")).select(
        "model", "n_rows", "p_rows", "c.budget", "c.k", F.col("c.at.score").alias("boundary_score"),
        (F.col("c.at.cum_tp") - F.col("c.at.tp")).alias("tp_above"),
        F.col("c.at.tp").alias("tp_tied"), F.col("c.at.n").alias("n_tied"),
        (F.col("c.k") - F.col("c.at.cum_n") + F.col("c.at.n")).alias("take"),
    )
    cuts = stage(cuts, "cuts")

    # At most one boundary score per (model, budget), so this side stays that small.
    partial = cuts.filter(F.col("take") < F.col("n_tied"))
    boundary = partial.select("model", F.col("boundary_score").alias("score")).distinct()
    tied = scored.join(F.broadcast(boundary), ["model", "score"]).select("model", "score", "row_id", "label")
    tied = row_rank(tied, ["model", "score"], [("row_id", "desc")], "place", rows_per_task)
    chosen = (
        tied.withColumnRenamed("score", "boundary_score")
        .join(F.broadcast(partial.select("model", "budget", "boundary_score", "take")), ["model", "boundary_score"])
        .filter(F.col("place") <= F.col("take"))
        .groupBy("model", "budget").agg(F.sum(F.col("label").cast("long")).alias("tp_chosen"))
    )
    rows = cuts.join(chosen, ["model", "budget"], "left")
    tp = F.col("tp_above") + F.coalesce(
        F.col("tp_chosen"), F.when(F.col("take") < F.col("n_tied"), F.lit(0)).otherwise(F.col("tp_tied"))
    )
    p = F.when(F.col("p_rows") > 0, F.col("p_rows")).otherwise(
        F.raise_error(F.lit("alert budgets need at least one positive row")).cast("long")
    )
    n, k = F.col("n_rows"), F.col("k")
    rows = rows.select("model", "budget", "k", "boundary_score", tp.alias("hit"), n.alias("n_rows"), p.alias("p_rows"))
    m = _metrics(F.col("hit"), k, n, F.col("p_rows"))
    return rows.select(
        "model", "budget", k.alias("alerts"), "boundary_score",
        *[m[name].alias(name) for name in ("accuracy", "precision", "recall", "f1_score", "tp", "fp", "fn", "tn")],
        F.when(F.col("hit") == 0, F.lit(float("inf"))).otherwise(k / F.col("hit")).alias("alerts_per_tp"),
    )


def best_per(rows: DataFrame, key: str, metric: str) -> DataFrame:
    """The row with the largest metric per key, the first model on ties; null metrics drop out.

    Runs on result tables, one row per (model, key).
    """
    order = Window.partitionBy(key).orderBy(F.desc(metric), F.asc("model"))
    return (
        rows.filter(F.col(metric).isNotNull()).withColumn("_r", F.row_number().over(order))
        .filter(F.col("_r") == 1).drop("_r")
    )


def pivot_models(rows: DataFrame, key: str, metric: str, models: Sequence[str]) -> DataFrame:
    """One row per key, one column per model."""
    return rows.groupBy(key).pivot("model", list(models)).agg(F.first(metric))


def selected_point(rows: DataFrame, model: str, target: float) -> DataFrame:
    return rows.filter((F.col("model") == model) & (F.abs(F.col("precision_target") - target) < 1e-9))


def confusion(scored: DataFrame, threshold: float) -> DataFrame:
    """tn, fp, fn, tp by model with ``score >= threshold``; every cell is present."""
    hit, bad = finite_score() >= threshold, F.col("label") == 1
    return scored.groupBy("model").agg(
        F.count_if(~hit & ~bad).alias("tn"), F.count_if(hit & ~bad).alias("fp"),
        F.count_if(~hit & bad).alias("fn"), F.count_if(hit & bad).alias("tp"),
    )


def threshold_metrics(scored: DataFrame, threshold: float) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    m = _metrics(tp, tp + fp, tn + fp + fn + tp, tp + fn)
    return confusion(scored, threshold).select("model", *[c.alias(name) for name, c in m.items()])


def classification_report(scored: DataFrame, threshold: float) -> DataFrame:
    """Precision, recall, F1 and support per class with macro and weighted averages."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def row(name: str, hit: Column, wrong: Column, missed: Column) -> Column:
        p, r = _ratio(hit, hit + wrong), _ratio(hit, hit + missed)
        return F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
            _ratio(2 * p * r, p + r).alias("f1_score"), (hit + missed).alias("support"),
        )

    per_class = confusion(scored, threshold).select(
        "model", row("0", tn, fn, fp).alias("a"), row("1", tp, fp, fn).alias("b")
    )
    parts = ("precision", "recall", "f1_score")
    total = F.col("a.support") + F.col("b.support")
    macro = [((F.col(f"a.{p}") + F.col(f"b.{p}")) / 2).alias(p) for p in parts]
    weighted = [
        _ratio(F.col(f"a.{p}") * F.col("a.support") + F.col(f"b.{p}") * F.col("b.support"), total).alias(p)
        for p in parts
    ]
    lines = F.array(
        F.col("a"), F.col("b"),
        F.struct(F.lit("macro avg").alias("class"), *macro, total.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), *weighted, total.alias("support")),
    )
    return per_class.select("model", F.explode(lines).alias("r")).select("model", "r.*")


def top_cases(scored: DataFrame, threshold: float) -> DataFrame:
    """The highest-scoring true and false positive of each model, first row on ties."""
    alerts = scored.filter(F.col("score") >= threshold)
    case = F.when(F.col("label") == 1, F.lit("true_positive")).otherwise(F.lit("false_positive"))
    return alerts.groupBy("model", case.alias("case")).agg(
        F.min_by(F.struct("row_id", "score"), F.struct(-F.col("score"), F.col("row_id"))).alias("r")
    ).select("model", "case", "r.*")
