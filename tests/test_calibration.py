"""Isotonic steps against a plain pass, in slices of any size."""

import random

import pytest

from finsieve.operators import calibration as ca


def plain(points):
    """One pass over sorted (score, label): the fitted value of every distinct score."""
    by = {}
    for s, y in points:
        n, p = by.get(s, (0, 0))
        by[s] = (n + 1, p + y)
    stack = []
    for s in sorted(by):
        stack.append([[s], *by[s]])
        while len(stack) > 1 and stack[-2][2] / stack[-2][1] >= stack[-1][2] / stack[-1][1]:
            x = stack.pop()
            stack[-1] = [stack[-1][0] + x[0], stack[-1][1] + x[1], stack[-1][2] + x[2]]
    return {s: p / n for ss, n, p in stack for s in ss}


def rows(spark, points, model="m"):
    return spark.createDataFrame([(model, i, y, s) for i, (s, y) in enumerate(points)], "model string, row_id long, label int, score double")


@pytest.mark.parametrize("rows_per_task", [1, 7, 60, 100_000])
def test_steps_do_not_depend_on_slices(spark, rows_per_task):
    rng = random.Random(1)
    rising = [(s := rng.randrange(300) / 300, int(rng.random() < s * s)) for _ in range(900)]
    falling = [(s := rng.randrange(50) / 50, int(rng.random() > s)) for _ in range(300)]
    both = rows(spark, rising, "up").unionByName(rows(spark, falling, "down")).unionByName(rows(spark, [(None, 1), (0.5, None)], "up"))
    got = {"up": {}, "down": {}}
    for r in ca.calibrate(both, ca.isotonic(both, rows_per_task)).collect():
        got[r.model][r.row_id] = r.score
    for model, points in (("up", rising), ("down", falling)):
        want = plain(points)
        for i, (s, _) in enumerate(points):
            if model == "down" or i > 1:
                assert got[model][i] == pytest.approx(want[s], abs=1e-12)
    steps = ca.isotonic(both, rows_per_task).orderBy("model", "low").collect()
    for a, b in zip(steps, steps[1:]):
        assert a.model != b.model or (a.high < b.low and a.value < b.value)


def test_scores_between_and_outside_steps(spark):
    fit = rows(spark, [(0.2, 0), (0.2, 0), (0.4, 1), (0.4, 0), (0.8, 1)])
    asked = rows(spark, [(0.0, 0), (0.2, 0), (0.3, 0), (0.4, 0), (0.6, 0), (0.8, 0), (1.0, 0), (None, 0)])
    out = {r.row_id: r.score for r in ca.calibrate(asked, ca.isotonic(fit)).collect()}
    assert [out[i] for i in range(7)] == pytest.approx([0, 0, 0.25, 0.5, 0.75, 1, 1]) and out[7] is None
    assert {r.score for r in ca.calibrate(rows(spark, [(0.5, 0)], "other"), ca.isotonic(fit)).collect()} == {None}
    assert ca.isotonic(fit.limit(0)).count() == 0 and ca.calibrate(asked.limit(0), ca.isotonic(fit)).count() == 0


def test_contingency_has_every_value_that_occurs(spark):
    from finsieve.operators import rates

    df = spark.createDataFrame([(0, "a"), (0, "a"), (1, None), (1, "new"), (None, "a")], "flag int, format string")
    got = {(r.flag, r.format): r.n for r in rates.contingency(df, "flag", "format").collect()}
    assert got == {(f, v): {(0, "a"): 2, (1, None): 1, (1, "new"): 1, (None, "a"): 1}.get((f, v), 0) for f in (0, 1, None) for v in ("a", None, "new")}
    assert rates.contingency(df.limit(0), "flag", "format").count() == 0
