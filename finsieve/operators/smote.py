"""Synthetic minority rows for mixed numeric and nominal features, from exact nearest neighbours.

The squared distance of two rows is that of their numbers, plus, for each nominal feature in
which they differ, the square of the median deviation of the numeric features in the class.
Equal rows are one point, so a class may hold any number of copies. Points go to the leaves
of a k-d tree; a point's distances in its own leaf bound the radius that its neighbours
can lie in, and it visits only leaves whose box reaches into that. Nothing is cut: the tree is drawn
from a sample, but every point is in a leaf and every leaf in reach is searched.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from statistics import median
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from finsieve.constants import BINARY_FEATURES, CATEGORICAL_FEATURES, NUMERIC_FEATURES, SEED, TARGET
from finsieve.operators.ordered import row_rank
from finsieve.operators.prep import first_by_hash
from finsieve.session import stage, stage_counted

NOMINAL = (*CATEGORICAL_FEATURES, *BINARY_FEATURES)
LEAF = 2048
#: Points that the tree's cuts are drawn from; it sets the balance of leaves, not the result.
TREE_SAMPLE = 100_000
NULL = "\u0000"
_ROWS = 256


def _coordinates(x: np.ndarray, c: Sequence[Sequence[str]]) -> np.ndarray:
    """Numbers next to a number for each nominal value: equal values have equal ones."""
    codes = np.array([[crc32(v.encode()) for v in row] for row in c], float).reshape(len(x), -1)
    return np.hstack([x, codes])


def _tree(points: np.ndarray, leaves: int, scale: np.ndarray) -> tuple | None:
    """Nested (axis, cut, low, high); None is a leaf. Cuts the widest axis at a value that has points on both sides."""
    if leaves < 2 or len(points) < 2:
        return None
    spread = np.ptp(points, axis=0) / scale
    axis = int(spread.argmax())
    values = np.sort(points[:, axis])
    if values[0] == values[-1]:
        return None
    cut = values[(len(values) - 1) // 2]
    cut = cut if cut < values[-1] else values[values < cut][-1]
    low = points[:, axis] <= cut
    return axis, cut, _tree(points[low], leaves // 2, scale), _tree(points[~low], leaves - leaves // 2, scale)


def _leaf_of(tree: tuple | None, points: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), np.int64)
    todo, n = [(tree, np.arange(len(points)))], 0
    while todo:
        node, at = todo.pop()
        if node is None:
            out[at], n = n, n + 1
            continue
        low = points[at, node[0]] <= node[1]
        todo += [(node[3], at[~low]), (node[2], at[low])]
    return out


def _nearest(asking: pd.DataFrame, base: pd.DataFrame, k: int, penalty: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For rows of ``asking``, a few at a time: squared distances to all of ``base``, and places of the k + 1 nearest with ties."""
    ax, bx = np.stack(asking.x.to_numpy()), np.stack(base.x.to_numpy())
    ac, bc = np.array(asking.c.tolist(), object), np.array(base.c.tolist(), object)
    pairs = [np.split(np.unique(np.concatenate([ac[:, j], bc[:, j]]), return_inverse=True)[1], [len(ac)]) for j in range(ac.shape[1])]
    for start in range(0, len(ax), _ROWS):
        part = slice(start, start + _ROWS)
        d = np.zeros((len(ax[part]), len(bx)))
        for j in range(ax.shape[1]):
            d += (ax[part, j, None] - bx[None, :, j]) ** 2
        d += penalty * sum((a[part, None] != b[None, :]).astype(float) for a, b in pairs)
        yield d, np.partition(d, k, axis=1)[:, k] if len(bx) > k else np.full(len(d), np.inf)


def neighbours(df: DataFrame, k: int = 5, key: str = "row_id", numeric: Sequence[str] = NUMERIC_FEATURES,
               nominal: Sequence[str] = NOMINAL, leaf: int = LEAF) -> DataFrame:
    """(key, rank, neighbour, distance2): the k nearest other rows of each row, ties to the smaller key.

    Rows with a null or not finite number take no part; a null nominal value is a value. With k rows or
    fewer, each has all others. ``key`` must be unique. The driver holds the tree and one box a leaf.
    """
    spark = df.sparkSession
    numbers = [F.col(c).cast("double") for c in numeric]
    rows = df.select(
        F.col(key).alias("_id"), F.array(*[n + 0.0 for n in numbers]).alias("x"),
        F.array(*[F.coalesce(F.col(c).cast("string"), F.lit(NULL)) for c in nominal]).alias("c"), *[n.alias(f"_n{i}") for i, n in enumerate(numbers)],
    )
    for i in range(len(numbers)):
        rows = rows.filter(F.col(f"_n{i}").isNotNull() & ~F.isnan(f"_n{i}") & (F.abs(f"_n{i}") != float("inf")))
    rows = stage(rows, "minority")
    deviations = [d or 0.0 for d in rows.agg(*[F.stddev_samp(f"_n{i}") for i in range(len(numbers))]).first()]
    penalty = median(deviations) ** 2
    ranked = stage(row_rank(rows.select("_id", "x", "c"), ["x", "c"], [("_id", "asc")], "_i"), "copies")
    points, n = stage_counted(ranked.filter(F.col("_i") <= k + 1).groupBy("x", "c").agg(F.sort_array(F.collect_list("_id")).alias("ids")), "points")
    kind = ranked.schema["_id"].dataType.simpleString()

    sample = points.select("x", "c").orderBy(F.xxhash64("x", "c")).limit(TREE_SAMPLE).toPandas()
    scale = np.array([d or 1.0 for d in deviations] + [2.0 ** 32] * len(nominal))
    tree = _tree(_coordinates(np.stack(sample.x), sample.c), -(-n // leaf), scale) if n else None

    def placed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b.assign(leaf=_leaf_of(tree, _coordinates(np.stack(b.x), b.c)))

    schema = f"x array<double>, c array<string>, ids array<{kind}>, leaf long"
    points = stage(points.mapInPandas(placed, schema), "leaves")

    def box(b: pd.DataFrame) -> pd.DataFrame:
        at = _coordinates(np.stack(b.x), b.c)
        return pd.DataFrame({"leaf": [b.leaf.iloc[0]], "low": [at.min(0)], "high": [at.max(0)]})

    boxes = points.groupBy("leaf").applyInPandas(box, "leaf long, low array<double>, high array<double>").toPandas()
    w = len(numeric)

    def found(asking: pd.DataFrame, base: pd.DataFrame, reach: bool) -> pd.DataFrame:
        out, at = [], 0
        order = base.ids.to_numpy()
        for d, edge in _nearest(asking, base, k, penalty):
            for i in range(len(d)):
                near = np.flatnonzero(d[i] <= edge[i])
                out.append((asking.ids.iloc[at][0], float(edge[i]) if reach else None, [(float(d[i][j]), list(order[j])) for j in near]))
                at += 1
        return pd.DataFrame(out, columns=["_p", "reach", "near"])

    near = f"near array<struct<d: double, ids: array<{kind}>>>"
    own = stage(points.groupBy("leaf").applyInPandas(lambda b: found(b, b, True), f"_p {kind}, reach double, {near}"), "own")

    def visits(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low, high, names = np.stack(boxes.low), np.stack(boxes.high), boxes.leaf.to_numpy()
        for b in batches:
            for start in range(0, len(b), _ROWS):
                part = b.iloc[start:start + _ROWS]
                at = _coordinates(np.stack(part.x), part.c)[:, None, :]
                off = np.maximum(0.0, np.maximum(low - at, at - high))
                least = (off[:, :, :w] ** 2).sum(2) + penalty * (off[:, :, w:] > 0).sum(2)
                hit = (least <= part.reach.to_numpy()[:, None] * (1 + 1e-9)) & (names != part.leaf.to_numpy()[:, None])
                i, j = np.nonzero(hit)
                yield part.iloc[i][["x", "c", "ids"]].assign(leaf=names[j])

    reached = points.join(own.select("_p", "reach"), points.ids[0] == own["_p"]).select("x", "c", "ids", "leaf", "reach")
    goes = stage(reached.mapInPandas(visits, schema), "visits")
    # A leaf with very many visitors is searched in parts of them.
    parts = goes.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / (4 * leaf)).cast("int").alias("_parts"))
    asking = goes.join(parts, "leaf").withColumn("_part", F.pmod(F.xxhash64("ids"), F.col("_parts")).cast("int")).drop("_parts")
    base = points.join(parts, "leaf").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    others = asking.groupBy("leaf", "_part").cogroup(base.groupBy("leaf", "_part")).applyInPandas(
        lambda a, b: found(a, b, False) if len(a) and len(b) else pd.DataFrame({"_p": [], "reach": [], "near": []}), f"_p {kind}, reach double, {near}")

    best = Window.partitionBy("_p").orderBy("d", "id")
    all_near = own.unionByName(others).select("_p", F.explode("near").alias("e")).select("_p", "e.d", F.explode("e.ids").alias("id"))
    top = all_near.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k + 1)
    top = top.groupBy("_p").agg(F.sort_array(F.collect_list(F.struct("d", "id"))).alias("top"))
    whose = points.select("x", "c", F.col("ids")[0].alias("_p")).join(top, "_p")
    lists = ranked.join(whose, ["x", "c"]).select("_id", F.slice(F.filter("top", lambda t: t.id != F.col("_id")), 1, k).alias("top"))
    return lists.select(F.col("_id").alias(key), F.posexplode("top").alias("rank", "t")).select(
        key, (F.col("rank") + 1).alias("rank"), F.col("t.id").alias("neighbour"), F.col("t.d").alias("distance2"))


def smotenc(train: DataFrame, n: int, k: int = 5, seed: int = SEED, key: str = "row_id", numeric: Sequence[str] = NUMERIC_FEATURES,
            nominal: Sequence[str] = NOMINAL, label: str = TARGET, leaf: int = LEAF) -> DataFrame:
    """``n`` synthetic rows of class 1: (key of the row they start from, copy, features, label).

    Copies are dealt evenly, the rest in hash order. A number lies between the row's and one drawn
    neighbour's; a nominal value is the most frequent of all k neighbours, ties to the smallest. A row without neighbours
    is repeated. Draws are hashes of (seed, key, copy), so they are the same on any cluster.
    """
    minority = train.filter(F.col(label) == 1).select(key, *numeric, *nominal)
    for c in numeric:
        minority = minority.filter(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(c) != float("inf")))
    minority, rows = stage_counted(minority, "class")
    if not rows:
        return train.select(key, F.lit(0).alias("copy"), *[F.col(c).cast("double").alias(c) for c in numeric], *nominal, label).limit(0)
    near = neighbours(minority, k, key, numeric, nominal, leaf)
    values = minority.select(F.col(key).alias("neighbour"), F.struct(*numeric, *nominal).alias("_v"))
    lists = near.join(values, "neighbour").groupBy(key).agg(F.sort_array(F.collect_list(F.struct("rank", "_v"))).alias("_near"))
    more = first_by_hash(minority.withColumnRenamed(key, "row_id"), rows and n % rows, seed) if n % rows else F.lit(False)
    copies = F.lit(n // rows) + F.when(more, 1).otherwise(0)
    base = minority.withColumn("row_id", F.col(key)).withColumn("_m", copies).filter("_m > 0")
    base = base.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_m"))))
    base = base.drop("_m", *(["row_id"] if key != "row_id" else [])).join(lists, key, "left")
    draw = lambda what: F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(what), F.lit(seed), F.col(key).cast("string"), F.col("copy"))), 1, 8), 16, 10).cast("long")
    pick = F.get("_near", F.pmod(draw("pick"), F.size("_near")).cast("int"))["_v"]
    gap = draw("gap") / F.lit(float(2 ** 32))
    own = {c: F.col(c).cast("double") for c in numeric}

    def most(c: str):
        value = F.transform("_near", lambda e: e["_v"][c])
        tally = F.transform(F.array_distinct(value), lambda v: F.struct((-F.size(F.filter(value, lambda w: w.eqNullSafe(v)))).alias("n"), v.alias("v")))
        return F.when(F.col("_near").isNull(), F.col(c)).otherwise(F.array_min(tally)["v"])

    return base.select(
        key, "copy", *[(x + F.coalesce(gap * (pick[c].cast("double") - x), F.lit(0.0))).alias(c) for c, x in own.items()],
        *[most(c).alias(c) for c in nominal], F.lit(1).alias(label),
    )
