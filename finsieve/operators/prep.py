"""Deterministic splits, samples, weights and preprocessing stages.

Random order is the order of a row hash, so every draw is the same on any cluster,
with any partitioning, and after a lost executor.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from finsieve.constants import (
    BINARY_FEATURES, CATEGORICAL_FEATURES, NUMERIC_FEATURES, SEED, TARGET, TEST_SHARE, UNDERSAMPLE_RATIO,
)
from finsieve.functions.columns import is_test, row_hash
from finsieve.session import stage


def split_by_hash(df: DataFrame, share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Add ``split``. No shuffle; each class keeps ``share`` in expectation."""
    return df.withColumn(
        "split", F.when(is_test("row_id", share, seed), F.lit("test")).otherwise(F.lit("train"))
    )


def hash_cut(df: DataFrame, n: int, seed: int = SEED) -> str | None:
    """The hash of the n-th row in hash order; None when there are fewer rows.

    Counts per three hex digits show which bucket holds that row; the bucket is opened
    three digits further until it holds one row or one hash. The passes read nothing
    but row_id and shuffle at most 4,096 counts per task, so an exact draw of any size
    becomes a filter. Rows that repeat a row_id share a hash and are drawn together.
    """
    rows = df.select(row_hash("row_id", seed).alias("h"))
    prefix, left = "", n
    while True:
        digit = F.substring("h", len(prefix) + 1, 3)
        counts = rows.filter(F.col("h").startswith(prefix)).groupBy(digit.alias("d")).agg(
            F.count(F.lit(1)).alias("n"), F.min("h").alias("low"), F.max("h").alias("high")
        ).orderBy("d").collect()
        for digits, size, low, high in counts:
            if left <= size:
                break
            left -= size
        else:
            return None
        if low == high:
            return low
        prefix += digits


def first_by_hash(df: DataFrame, n: int, seed: int = SEED) -> Column:
    """Whether a row is among the first ``n`` in hash order."""
    cut = hash_cut(df, n, seed) if n > 0 else ""
    return F.lit(True) if cut is None else row_hash("row_id", seed) <= F.lit(cut)


def split_exact(df: DataFrame, share: float = TEST_SHARE, seed: int = SEED, label: str = TARGET) -> DataFrame:
    """Add ``split`` with exact sizes: ceil(share * n) test rows, shared out over the
    classes in proportion, the largest remainders first."""
    sizes = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    total = sum(sizes.values())
    n_test = math.ceil(share * total)
    quota = {c: n_test * n / total for c, n in sizes.items()}
    take = {c: math.floor(q) for c, q in quota.items()}
    left = n_test - sum(take.values())
    for c in sorted(quota, key=lambda c: (take[c] - quota[c], c))[:left]:
        take[c] += 1
    chosen = F.lit(False)
    for c, n in take.items():
        mine = F.col(label) == c
        chosen = chosen | (mine & first_by_hash(df.filter(mine), n, seed))
    return df.withColumn("split", F.when(chosen, F.lit("test")).otherwise(F.lit("train")))


def split_manifest(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Rows and positives by split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("n_positive")
    )


def class_weights(train: DataFrame, label: str = TARGET) -> DataFrame:
    """One row of imbalance weights, from the train fold only."""
    n_pos = F.sum(F.col(label).cast("long"))
    n = F.count(F.lit(1))
    counts = train.agg(n.alias("n"), n_pos.alias("n_pos"))
    checked = F.when(F.col("n_pos") > 0, F.col("n_pos")).otherwise(
        F.raise_error(F.lit("the train fold has no positive rows")).cast("long")
    )
    return counts.select(
        "n", checked.alias("n_pos"), (F.col("n") - F.col("n_pos")).alias("n_neg")
    ).select(
        "n", "n_pos", "n_neg",
        (F.col("n_neg") / F.col("n_pos")).alias("scale_pos_weight"),
        (F.col("n") / (2 * F.col("n_neg"))).alias("balanced_neg"),
        (F.col("n") / (2 * F.col("n_pos"))).alias("balanced_pos"),
    )


def add_weight(train: DataFrame, kind: str, label: str = TARGET) -> DataFrame:
    """Add ``weight``: ``scale_pos`` weighs positives only, ``balanced`` both classes."""
    w = class_weights(train, label).first()
    pos, neg = (w.scale_pos_weight, 1.0) if kind == "scale_pos" else (w.balanced_pos, w.balanced_neg)
    return train.withColumn("weight", F.when(F.col(label) == 1, F.lit(pos)).otherwise(F.lit(neg)))


def undersample(train: DataFrame, ratio: float = UNDERSAMPLE_RATIO, seed: int = SEED, label: str = TARGET) -> DataFrame:
    """All positives and, without replacement, n_pos / ratio negatives in hash order."""
    positive = F.col(label) == 1
    keep = int(train.filter(positive).count() / ratio)
    return train.filter(positive | first_by_hash(train.filter(F.col(label) == 0), keep, seed))


def seeded_sample(df: DataFrame, n: int, seed: int = SEED) -> DataFrame:
    """Exactly min(n, rows) rows without replacement."""
    return df.filter(first_by_hash(df, n, seed))


#: Bins of a number, as many as a tree of ``pyspark.ml`` tells apart, and the quantiles a class that their cuts are read off.
BINS = 32
GRID = 1000
#: Rows that stand for a cell of more rows. Trees draw rows and ask for a number of them in a node: more than both need.
CELL_ROWS = 20
_CELLS_A_TASK = 25_000


def bin_cuts(train: DataFrame, columns: Sequence[str], weight: str | None = None, label: str = TARGET) -> dict[str, list[float]]:
    """Up to ``BINS`` - 1 cuts a column that part the training weight evenly, halfway between values as trees cut.

    Values come from sketches per class: ``GRID`` quantiles of each are collected.
    """
    at = [(i + 0.5) / GRID for i in range(GRID)]
    value = {c: F.col(c).cast("double") for c in columns}
    known = {c: F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v) for c, v in value.items()}
    mass = F.col(weight) if weight else F.lit(1.0)
    rows = train.groupBy(label).agg(*[
        x for c, v in known.items()
        for x in (F.percentile_approx(v, at, 100_000).alias(f"q_{c}"), F.sum(F.when(v.isNotNull(), mass)).alias(f"w_{c}"))
    ]).collect()
    cuts = {}
    for c in columns:
        some = [r for r in rows if r[f"q_{c}"]]
        grid = np.array([x for r in some for x in r[f"q_{c}"]])
        share = np.array([r[f"w_{c}"] / GRID for r in some for _ in range(GRID)])
        values, which = np.unique(grid, return_inverse=True)
        places = np.arange(max(0, len(values) - 1))
        if len(values) > BINS:
            cum = np.bincount(which, share).cumsum()
            places = np.unique(np.searchsorted(cum, cum[-1] * np.arange(1, BINS) / BINS).clip(0, len(values) - 2))
        cuts[c] = ((values[places] + values[places + 1]) / 2).tolist() if len(places) else []
    return cuts


def binning(cuts: dict[str, list[float]]) -> SQLTransformer:
    """A stage that adds ``<column>_bin``: how many cuts lie below the number. Null stays null, NaN is above all."""
    bins = [
        f"case when `{c}` is not null then cast(size(filter(cast(array({', '.join(f'{x!r}D' for x in at)}) as array<double>), t -> t < `{c}`)) as double) end as `{c}_bin`"
        for c, at in cuts.items()
    ]
    return SQLTransformer(statement=f"select *, {', '.join(bins)} from __THIS__")


def cells(binned: DataFrame, keys: Sequence[str], weight: str | None = None, most: int = CELL_ROWS) -> DataFrame:
    """One row with a ``weight`` for each row of a cell, the rows equal in ``keys``; ``most`` equal ones for a larger cell.

    Trees that cut between bins see nothing but cells, so a fit costs as much as there are cells, however
    many rows they hold. No row is left out: the weights of a cell sum to those of its rows.
    """
    keys = [*keys, *([weight] if weight else [])]
    counted = binned.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rows = F.least(F.col("_n"), F.lit(most).cast("long"))
    share = (F.col(weight) if weight else F.lit(1.0)) * F.col("_n") / rows
    spread = stage(counted.select(*[k for k in keys if k != weight], share.alias("weight"), F.explode(F.sequence(F.lit(1), rows)).alias("_i")), "cells")
    parts = 1 + spread.count() // _CELLS_A_TASK
    # Dealt and sorted by value, so that draws within a fit do not hang on the order that rows came in.
    return stage(spread.repartition(parts, *spread.columns).sortWithinPartitions(*spread.columns).drop("_i"), "cells")


def preprocessing(scale: bool = False, drop: Sequence[str] = (), binned: bool = False) -> Pipeline:
    """One-hot ‖ numeric ‖ binary into ``features``; unknown categories become all zeros.

    ``scale`` standardises the numeric part, for linear models only; ``binned`` takes bins for numbers.
    """
    cats = [c for c in CATEGORICAL_FEATURES if c not in drop]
    nums = [f"{c}_bin" if binned else c for c in NUMERIC_FEATURES if c not in drop]
    flags = [c for c in BINARY_FEATURES if c not in drop]
    stages = []
    for c in cats:
        stages += [
            StringIndexer(inputCol=c, outputCol=f"{c}_ix", handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCol=f"{c}_ix", outputCol=f"{c}_oh", dropLast=True),
        ]
    inputs = [f"{c}_oh" for c in cats]
    if scale:
        stages += [
            VectorAssembler(inputCols=nums, outputCol="numeric"),
            StandardScaler(inputCol="numeric", outputCol="numeric_scaled", withMean=True, withStd=True),
        ]
        inputs += ["numeric_scaled", *flags]
    else:
        inputs += [*nums, *flags]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=inputs, outputCol="features")])

