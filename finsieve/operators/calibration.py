"""Probability calibration by isotonic regression, pooled in slices that are merged.

Pooling adjacent violators can start anywhere: pooled blocks of neighbouring parts, put one after the other and
pooled again, are the blocks of the whole. So scores are counted, cut into slices of the score order, each
slice is pooled to its rising stack of blocks, and ``FAN`` neighbouring stacks at a time are merged until each
model has one. Only rising blocks are ever carried on, never rows.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from finsieve.operators.ordered import ROWS_PER_TASK, running_sums
from finsieve.session import stage

FAN = 16
Block = tuple[float, float, float, float]


def pooled(blocks: Iterable[Block]) -> list[Block]:
    """Blocks (low, high, weight, sum) along rising scores, pooled until their means rise."""
    stack: list[Block] = []
    for low, high, weight, total in blocks:
        while stack and stack[-1][3] * weight >= total * stack[-1][2]:
            low, _, w, s = stack.pop()
            weight, total = weight + w, total + s
        stack.append((low, high, weight, total))
    return stack


def _pool(table: pa.Table) -> pa.Table:
    rows = table.sort_by("low").to_pydict()
    low, high, weight, total = zip(*pooled(zip(rows["low"], rows["high"], rows["n"], rows["positive"])))
    head = {c: pa.array([rows[c][0]] * len(low), table.schema.field(c).type) for c in ("model", "part")}
    return pa.table(head | {"low": pa.array(low), "high": pa.array(high), "n": pa.array(weight, pa.float64()), "positive": pa.array(total, pa.float64())})


def isotonic(scored: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(model, low, high, value): the non-decreasing step function of the score closest to the labels in squares.

    Rows without a score or a label take no part. Equal scores are one point.
    """
    counts = scored.dropna(subset=["score", "label"]).groupBy("model", F.col("score").alias("low")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col("label").cast("double")).alias("positive")
    )
    # A slice number that rises with the score and holds so many points: the place along each model's scores.
    placed = running_sums(counts.withColumn("_one", F.lit(1)), ["model"], [("low", "asc")], {"_at": "_one"}, rows_per_task=rows_per_task)
    level = placed.select("model", F.floor((F.col("_at") - 1) / rows_per_task).cast("bigint").alias("part"), "low", F.col("low").alias("high"), "n", "positive")
    shape = f"model {level.schema['model'].dataType.simpleString()}, part bigint, low double, high double, n double, positive double"
    while True:
        level = stage(level.groupBy("model", "part").applyInArrow(_pool, shape), "stacks")
        if not level.filter("part > 0").limit(1).count():
            return level.select("model", "low", "high", (F.col("positive") / F.col("n")).alias("value"))
        level = level.withColumn("part", F.floor(F.col("part") / FAN).cast("bigint"))


def calibrate(scored: DataFrame, steps: DataFrame) -> DataFrame:
    """``scored`` with its score replaced by the calibrated one; a model without steps, or a null score, gets null.

    A score inside a step gets its value, one between two steps lies on the line between them, one outside
    gets the nearest value. Distinct scores and steps are put in one order, where a running count finds each
    score's step; rows then get their value by an equal join.
    """
    asked = scored.select("model", "score").dropna().distinct().select("model", "score", F.lit(1).alias("kind"), F.lit(0).alias("step"))
    ends = steps.select("model", F.col("low").alias("score"), F.lit(0).alias("kind"), F.lit(1).alias("step"), "high", "value")
    line = ends.unionByName(asked, allowMissingColumns=True)
    found = stage(running_sums(line, ["model"], [("score", "asc"), ("kind", "asc")], {"k": "step"}), "places")
    step = found.filter("kind = 0").select("model", "k", F.col("score").alias("low"), "high", "value")
    last = step.select("model", F.col("k"), F.col("high").alias("h0"), F.col("value").alias("v0"))
    after = step.select("model", (F.col("k") - 1).alias("k"), F.col("low").alias("l1"), F.col("value").alias("v1"))
    near = found.filter("kind = 1").select("model", "score", "k").join(last, ["model", "k"], "left").join(after, ["model", "k"], "left")
    share = (F.col("score") - F.col("h0")) / (F.col("l1") - F.col("h0"))
    value = F.when(F.col("v0").isNull(), F.col("v1")).when((F.col("score") <= F.col("h0")) | F.col("v1").isNull(), F.col("v0")).otherwise(
        F.col("v0") + share * (F.col("v1") - F.col("v0"))
    )
    return scored.join(near.select("model", "score", value.alias("_value")), ["model", "score"], "left").withColumn("score", F.col("_value")).select(
        *scored.columns
    )
