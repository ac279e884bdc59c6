"""Neighbours in a mixed metric against brute force, and what synthetic rows are made of."""

import random
from collections import Counter
from statistics import median, stdev

import pytest

from finsieve.operators import smote

NUM, NOM = ("a", "b"), ("f", "g")
SCHEMA = "row_id long, a double, b long, f string, g int, is_laundering int"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = [(i, round(rng.lognormvariate(3, 1), 1), rng.randrange(30), rng.choice(["x", "y", None, ""]), rng.randrange(2), 1) for i in range(500)]
    out += [(1000 + i, 5.0, 0, "x", 1, 1) for i in range(250)]  # a third are copies of one row
    return out


def brute(rows, k):
    penalty = median(stdev(r[i] for r in rows) for i in (1, 2)) ** 2
    out = {}
    for r in rows:
        near = sorted((((r[1] - s[1]) ** 2 + (r[2] - s[2]) ** 2 + penalty * ((r[3] != s[3]) + (r[4] != s[4]))), s[0]) for s in rows if s[0] != r[0])
        out[r[0]] = near[:k]
    return out


def test_neighbours_equal_brute_force_and_rows_are_mixed_from_them(spark, rows):
    odd = [(2000, None, 1, "x", 0, 1), (2001, float("nan"), 1, "x", 0, 1), (2002, 1.0, 1, "x", 0, 0)]
    df = spark.createDataFrame(rows + odd, SCHEMA).repartition(5)
    want = brute(rows, 5)
    got = {}
    for r in smote.neighbours(df.filter("is_laundering = 1"), 5, numeric=NUM, nominal=NOM, leaf=32).orderBy("row_id", "rank").collect():
        got.setdefault(r.row_id, []).append((r.distance2, r.neighbour))
    assert set(got) == set(want)
    for i, near in want.items():
        assert [d for d, _ in got[i]] == pytest.approx([d for d, _ in near], rel=1e-9, abs=1e-9)
        assert [n for _, n in got[i]] == [n for _, n in near]

    by_id = {r[0]: r for r in rows}
    made = smote.smotenc(df, 1000, numeric=NUM, nominal=NOM, leaf=64).collect()
    assert len(made) == 1000 and len({(r.row_id, r.copy) for r in made}) == 1000
    assert set(Counter(r.row_id for r in made).values()) == {1, 2}
    for r in made:
        own, near = by_id[r.row_id], [by_id[n] for _, n in want[r.row_id]]
        assert any(min(own[1], s[1]) - 1e-9 <= r.a <= max(own[1], s[1]) + 1e-9 and min(own[2], s[2]) - 1e-9 <= r.b <= max(own[2], s[2]) + 1e-9 for s in near)
        counts = Counter(s[3] for s in near)
        assert counts[r.f] == max(counts.values())


def test_small_classes(spark, rows):
    df = spark.createDataFrame(rows[:1], SCHEMA)
    assert [(r.a, r.b, r.f) for r in smote.smotenc(df, 2, numeric=NUM, nominal=NOM).collect()] == [(rows[0][1], float(rows[0][2]), rows[0][3])] * 2
    assert smote.smotenc(df.filter("is_laundering = 0"), 3, numeric=NUM, nominal=NOM).count() == 0
