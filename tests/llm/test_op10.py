"""Neighbours against all distances, with small tiles and blocks."""

import math

import numpy as np

from finsieve.llm import op10_neighbours as knn


def plain(rows, k, every):
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (i, v) in enumerate(good):
        if i % every == 0:
            near = []
            for b, (j, w) in enumerate(good):
                if a != b and len(v) == len(w):
                    total = 0.0
                    for x, y in zip(v, w):
                        total += (float(x) - float(y)) * (float(x) - float(y))
                    near.append((math.sqrt(total), j))
            out += [(i, r, j, d) for r, (d, j) in enumerate(sorted(near)[:k], 1)]
    return sorted(out)


def test_all_kinds_of_rows(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(300, 6)).astype(np.float32)
    rows = [(i, base[i % 250].tolist()) for i in range(300)]
    rows += [(10, base[3].tolist()), (10, base[3].tolist()), (400, [2.0**100, -(2.0**100), 0.0, 0.0, 0.0, 1.0]), (500, [1.0, 2.0]), (510, [1.0, 2.5]), (501, [2.0, 2.0])]
    rows += [(600, None), (601, []), (602, [0.0] * 6), (603, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (604, [float("nan")] * 6), (605, [float("inf")] * 6), (None, base[0].tolist())]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, id string").repartition(5)
    got = sorted(tuple(r) for r in knn.neighbours(frame, k=7, every=10, tile=32, block=64, queries=16).collect())
    assert got == plain(rows, 7, 10)


def test_empty_and_alone(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert knn.neighbours(none).count() == 0
    one = spark.createDataFrame([(100, [1.0])], "vec_id long, embedding array<double>")
    assert knn.neighbours(one).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(50, 64)) * rng.lognormal(size=(50, 1)) * 100
    codes, scale, norm, error = knn.quantised(x)
    back = codes * scale[:, None]
    assert np.abs(codes.astype(int)).max() <= 127
    assert np.allclose(np.linalg.norm(x - back, axis=1), error) and np.allclose((back**2).sum(axis=1), norm)
