"""Hand-checked ranking tables: ties, no positives, unreachable targets."""

import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from finsieve.operators import gates, ranking as rk


def frame(spark, rows, model="m"):
    return spark.createDataFrame([(model, i, y, float(s)) for i, (s, y) in enumerate(rows, 1)],
                                 "model string, row_id long, label int, score double")


AP6 = [(0.9, 1), (0.8, 0), (0.7, 1), (0.7, 0), (0.2, 0), (0.1, 1)]


def test_average_precision_steps_over_distinct_scores(spark):
    row = rk.average_precision(frame(spark, AP6)).first()
    assert row.average_precision == pytest.approx(1 / 3 + 1 / 3 * 2 / 4 + 1 / 3 * 3 / 6)
    assert row.max_precision == 1.0


def test_curve_is_the_same_when_spread(spark):
    rows = [((i * 37) % 101 / 100, int(i % 9 == 0)) for i in range(2000)]
    plain, spread = (rk.pr_curve(frame(spark, rows), n).orderBy("threshold").collect() for n in (10**6, 7))
    assert plain == spread


def test_no_positives(spark):
    scored = frame(spark, [(0.9, 0), (0.1, 0)])
    m = rk.threshold_metrics(scored, 0.5).first()
    assert (m.precision, m.recall, m.f1_score, m.accuracy) == (0.0, 0.0, 0.0, 0.5)
    fixed = rk.fixed_precision(scored, [0.02]).first()
    assert fixed.threshold is None and fixed.precision is None and fixed.alerts == 0 and (fixed.fn, fixed.tn) == (0, 2)
    with pytest.raises(PySparkException, match="at least one positive"):
        rk.alert_budgets(scored, [0.5]).collect()


def test_unreachable_target(spark):
    scored = frame(spark, [(0.9, 0), (0.8, 1), (0.7, 0), (0.6, 1)])
    row = rk.operating_point(scored, 0.9).first()
    assert row.reached is False and row.threshold == 0.6 and row.alerts == 4
    fixed = rk.fixed_precision(scored, [0.4, 0.9]).orderBy("precision_target").collect()
    assert fixed[0].threshold == pytest.approx(0.6) and fixed[0].recall == 1.0
    assert fixed[1].threshold is None and fixed[1].recall is None and fixed[1].fn == 2


def test_smallest_threshold_that_reaches_the_target(spark):
    row = rk.operating_point(frame(spark, AP6), 0.5).first()
    assert row.reached and row.threshold == 0.1


def test_budget_takes_the_last_row_of_a_tie(spark):
    scored = frame(spark, [(0.5, 1), (0.5, 0), (0.5, 0), (0.5, 1)])
    assert rk.alert_budgets(scored, [0.25]).first().tp == 1
    flipped = frame(spark, [(0.5, 1), (0.5, 0), (0.5, 0), (0.5, 0)])
    row = rk.alert_budgets(flipped, [0.25]).first()
    assert row.tp == 0 and math.isinf(row.alerts_per_tp) and row.alerts == 1


@pytest.mark.parametrize("rows_per_task", [5, 10**6])
def test_budgets_against_numpy(spark, rows_per_task):
    rng = np.random.default_rng(5)
    score, label = rng.integers(0, 12, 700) / 10, (rng.random(700) < 0.1).astype(int)
    score[:240] = 0.7  # a third of the rows share one score
    budgets = [0.001, 0.01, 0.05, 0.2, 0.5, 1.0]
    got = {r.budget: r for r in rk.alert_budgets(frame(spark, [(s, int(y)) for s, y in zip(score, label)]), budgets, rows_per_task).collect()}
    order = np.lexsort((np.arange(700), score.astype(np.float32)))[::-1]
    for b in budgets:
        k = max(1, math.ceil(700 * b))
        assert got[b].alerts == k and got[b].tp == label[order[:k]].sum()
        assert got[b].boundary_score == pytest.approx(float(np.float32(score[order[k - 1]])))
    recalls = [got[b].recall for b in budgets]
    assert recalls == sorted(recalls)


@pytest.mark.parametrize("bad", [0.0, -0.1, 1.5])
def test_bad_budget(spark, bad):
    with pytest.raises(ValueError):
        rk.alert_budgets(frame(spark, AP6), [bad])


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), None])
def test_scores_must_be_finite(spark, bad):
    df = frame(spark, AP6).withColumn("score", F.when(F.col("row_id") == 2, F.lit(bad).cast("double")).otherwise(F.col("score")))
    with pytest.raises(PySparkException, match="finite"):
        rk.average_precision(df).collect()


def test_counts_add_up(spark):
    m = rk.threshold_metrics(frame(spark, AP6), 0.7).first()
    assert (m.tp, m.fp, m.fn, m.tn) == (2, 2, 1, 1) and m.alerts == 4


def test_best_per_takes_the_first_model_on_ties(spark):
    rows = spark.createDataFrame([("b", 0.1, 0.5), ("a", 0.1, 0.5), ("c", 0.1, None), ("a", 0.2, None)],
                                 "model string, target double, recall double")
    assert [(r.model, r.target) for r in rk.best_per(rows, "target", "recall").collect()] == [("a", 0.1)]


def test_regression_gate_is_two_sided(spark):
    base = spark.createDataFrame([("x", "recall", 0.5), ("x", "alerts", 100.0), ("x", "tp", 5.0), ("x", "threshold", 0.0)],
                                 "model string, metric string, value double")
    seen = spark.createDataFrame([("m", "recall", 0.6), ("m", "alerts", 109.0), ("m", "tp", 50.0), ("m", "threshold", 0.2), ("m", "new", 1.0)],
                                 "model string, metric string, value double")
    rows = {r.metric: r for r in gates.regression_rows(seen, base).collect()}
    assert {k: r.status for k, r in rows.items()} == {"recall": "regressed", "alerts": "ok", "tp": "info", "threshold": "ok"}
    assert rows["threshold"].relative == 0.0
    verdict = gates.regression_verdict(gates.regression_rows(seen, base)).first()
    assert verdict.failing == ["recall"] and not verdict.passed


def test_metrics_long_derives_and_rejects(spark):
    df = spark.createDataFrame([("m", 2.0, 2.0, 1.0, 5.0, 0.5, 2 / 3, 10.0)],
                               "model string, tp double, fp double, fn double, tn double, precision double, recall double, n_test double")
    got = {r.metric: r.value for r in gates.metrics_long(df, "n_test").collect()}
    assert got["accuracy"] == 0.7 and got["alerts"] == 4.0 and got["alert_rate_pct"] == 40.0
    assert got["f1_score"] == pytest.approx(4 / 7)
    empty = spark.createDataFrame([("m", None)], "model string, recall double")
    with pytest.raises(PySparkException, match="no metrics"):
        gates.metrics_long(empty).collect()


def test_top_cases_first_row_on_ties(spark):
    got = {r.case: r.row_id for r in rk.top_cases(frame(spark, [(0.9, 1), (0.9, 1), (0.8, 0), (0.8, 0), (0.2, 0)]), 0.5).collect()}
    assert got == {"true_positive": 1, "false_positive": 3}
