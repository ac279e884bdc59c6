"""PSI edge cases and persistence."""

import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from finsieve.operators import drift as dr
from finsieve.streaming import policy


def numbers(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


def numpy_psi(ref, cur):
    edges = np.unique(np.quantile(ref, np.arange(11) / 10))
    edges = np.array([-np.inf, edges[0], np.inf]) if len(edges) < 2 else np.r_[-np.inf, edges[1:-1], np.inf]
    r, c = (np.histogram(v, bins=edges)[0] + 1e-6 for v in (ref, cur))
    r, c = r / r.sum(), c / c.sum()
    return float(((c - r) * np.log(c / r)).sum()), len(edges) - 1


@pytest.mark.parametrize("ref,cur", [
    ([5.0] * 20, [5.0, 6.0, 4.0]),                       # a constant: two bins
    ([0.0] * 30 + [1.0] * 3, [0.0, 1.0, 1.0, 2.0]),      # two values, deciles mostly equal
    ([0.0] * 50 + [1.0] * 50, [0.0, 0.0, 1.0]),
    (list(range(100)), [3.0, 250.0, -7.0, 40.0]),        # empty bins
    ([1, 1, 1, 2, 2, 9, 30, 30, 31, 500], [1, 30, 30]),  # values on the edges
])
def test_numeric_psi(spark, ref, cur):
    ref, cur = [float(v) for v in ref], [float(v) for v in cur]
    profile = dr.reference_profile(numbers(spark, ref), {"x": "numeric"})
    row = dr.drift_report(profile, numbers(spark, cur)).first()
    psi, bins = numpy_psi(ref, cur)
    assert row.psi == pytest.approx(psi, rel=1e-9, abs=1e-12) and row.bucket_count == bins


def test_two_edges_leave_one_bin(spark):
    profile = dr.reference_profile(numbers(spark, [0.0, 1.0] * 5), {"x": "numeric"}, bins=1)
    row = dr.drift_report(profile, numbers(spark, [0.0, 9.0])).first()
    assert row.bucket_count == 1 and row.psi == pytest.approx(0.0, abs=1e-12) and row.signal == "low"


def test_missing_number_is_rejected(spark):
    profile = dr.reference_profile(numbers(spark, [1.0, 2.0, 3.0]), {"x": "numeric"})
    with pytest.raises(PySparkException, match="numeric and present"):
        dr.drift_report(profile, numbers(spark, [1.0, None])).collect()


def test_categorical_union_and_missing(spark):
    ref = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [(None,)], "x string")
    cur = spark.createDataFrame([("a",)] * 2 + [("c",)] * 2, "x string")
    row = dr.drift_report(dr.reference_profile(ref, {"x": "categorical"}), cur).first()
    r, c = np.array([6, 3, 1, 0]) + 1e-6, np.array([2, 0, 0, 2]) + 1e-6
    r, c = r / r.sum(), c / c.sum()
    assert row.bucket_count == 4 and row.psi == pytest.approx(float(((c - r) * np.log(c / r)).sum()))


@pytest.mark.parametrize("psi,signal", [(0.0999, "low"), (0.10, "moderate"), (0.2499, "moderate"), (0.25, "significant")])
def test_classes(spark, psi, signal):
    assert spark.createDataFrame([(psi,)], "psi double").select(dr.classify_psi()).first()[0] == signal


def test_same_population_has_no_drift(spark):
    df = numbers(spark, range(500))
    assert dr.drift_report(dr.reference_profile(df, {"x": "numeric"}), df).first().psi == pytest.approx(0.0, abs=1e-12)


def test_summary_counts_prediction_drift(spark):
    rows = [("b", "numeric", 0.12, "moderate"), ("a", "binary", 0.11, "moderate"), ("score", "prediction", 0.3, "significant")]
    got = dr.drift_summary(spark.createDataFrame(rows, "feature string, type string, psi double, signal string")).first()
    assert got.overall_signal == "significant" and got.moderate_features == ["a", "b"]
    assert got.significant_features == [] and got.prediction_signal == "significant"


def test_windows_equal_separate_reports(spark):
    ref = numbers(spark, [math.sqrt(i) for i in range(300)])
    cur = spark.range(90).select((F.col("id") % 3).alias("w"), (F.col("id") / 9).alias("x"))
    profile = dr.reference_profile(ref, {"x": "numeric"})
    both = {r.w: r.psi for r in dr.drift_report(profile, cur, ["w"]).collect()}
    for w in range(3):
        assert both[w] == pytest.approx(dr.drift_report(profile, cur.filter(F.col("w") == w).drop("w")).first().psi)


def test_persistence(spark):
    flags = [False, True, True, False, True, True, True, True, False]
    days = spark.createDataFrame(list(enumerate(flags)), "d int, condition boolean")
    df = days.select(F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, d)").alias("window_start"), "condition")
    got = [(r.streak, r.investigate) for r in policy.persistence(df).orderBy("window_start").collect()]
    assert [s for s, _ in got] == [0, 1, 2, 0, 1, 2, 3, 4, 0]
    assert [i for _, i in got] == [False] * 6 + [True, True, False]


def test_a_missing_window_ends_a_run(spark):
    days = spark.createDataFrame([(1,), (5,), (6,), (20,)], "d int")
    df = days.select(F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, d)").alias("window_start"), F.lit(True).alias("condition"))
    assert [r.streak for r in policy.persistence(df).orderBy("window_start").collect()] == [1, 1, 2, 1]
    longer = policy.persistence(df.filter("window_start > timestamp'2024-01-03'"), every="14 days")
    assert [r.streak for r in longer.orderBy("window_start").collect()] == [1, 1, 2]


def test_retraining_needs_every_condition(spark):
    quality = spark.createDataFrame([("m", True)], "model string, passed boolean")
    gate = lambda relative: spark.createDataFrame(
        [("m", "average_precision", relative, 0.05, "ok" if abs(relative) <= 0.05 else "regressed"), ("m", "threshold", 0.0, 0.05, "ok")],
        "model string, metric string, relative double, tolerance double, status string")
    same, worse, better = gate(0.0), gate(-0.06), gate(0.06)
    labels = spark.createDataFrame([("m", 50)], "model string, n_labels long")
    seen = lambda flag, inputs=False: spark.createDataFrame([(flag, inputs)], "investigate boolean, input_drift boolean")
    decide = lambda *a: policy.retrain_decision(*a).first()
    assert decide(seen(True), quality, worse, labels, 50).retrain_eligible
    assert not decide(seen(False), quality, worse, labels, 50).retrain_eligible
    assert not decide(seen(True), quality, worse, labels, 51).retrain_eligible
    assert not decide(seen(True), quality, same, labels, 50).retrain_eligible
    assert decide(seen(True, True), quality, same, labels, 50).retrain_eligible
    assert not decide(seen(True), quality, better, labels, 50).retrain_eligible
    assert decide(seen(True), quality, same, labels, 50).promote


def test_a_saved_profile_needs_no_reference(spark, tmp_path):
    ref = spark.createDataFrame([(float(i % 7), "ab"[i % 2]) for i in range(200)], "x double, c string")
    ref.write.parquet(str(tmp_path / "reference"))
    stored = spark.read.parquet(str(tmp_path / "reference"))
    built = dr.reference_profile(stored, {"x": "numeric", "c": "categorical"})
    dr.save_profile(built, str(tmp_path / "profile"))
    loaded = dr.load_profile(spark, str(tmp_path / "profile"))
    cur = spark.createDataFrame([(3.0, "b"), (9.0, "z"), (1.0, None)], "x double, c string")
    report = dr.drift_report(loaded, cur)
    same = {r.feature: (r.psi, r.bucket_count) for r in dr.drift_report(built, cur).collect()}
    assert {r.feature: (r.psi, r.bucket_count) for r in report.collect()} == same
    assert not [f for f in [*report.inputFiles(), *loaded.buckets.inputFiles(), *loaded.edges.inputFiles()] if "/reference/" in f]
