"""Ranks, running sums and exact quantiles that never put a large group in one task.

A window over a group runs in one task. So rows are range-partitioned by group and
order, stamped with the slice they fell into, and written in buckets of slices; windows
then run per (group, slice) where the rows lie, and the totals of a group's earlier slices
are added as offsets. Only the first and last group of a slice can have any. A group
holding a third of the table is spread like any other, and rows move once. There is this
one way for every size; ``rows_per_task`` only sets how large a slice is.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from finsieve.session import stage, stage_bucketed, stage_counted

#: Small enough that a slice of wide rows is sorted in memory; a slice that spills moves its rows two more times.
ROWS_PER_TASK = 250_000
#: A slice of its own, where there are fewer slices than shuffle partitions.
WORTH_A_TASK = 50_000
_SLICE = "_slice"
Order = Sequence[tuple[str, str]]


def _sort(order: Order) -> list[Column]:
    return [F.col(c).desc() if way == "desc" else F.col(c).asc() for c, way in order]


def _sliced(df: DataFrame, keys: Sequence[str], order: Order, rows: int, rows_per_task: int) -> DataFrame:
    """Range-partition by (keys, order) and write each row with its slice's number, bucketed by it.

    This is the one time that rows move: what follows groups by slice and finds them in place.
    """
    parallel = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(2, min(parallel, rows // WORTH_A_TASK), math.ceil(rows / rows_per_task) + 1)
    ranged = df.repartitionByRange(n, *keys, *_sort(order))
    return stage_bucketed(ranged.withColumn(_SLICE, F.spark_partition_id()), _SLICE, n, "sliced")


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right["_k_" + key])
    return condition


def _group(keys: Sequence[str]) -> Column:
    return F.struct(*keys) if keys else F.struct(F.lit(0).alias("_none"))


def _edges(rows: DataFrame, keys: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """One row per slice with its first and its last group: sums over earlier slices and over all.

    Slices follow the order of groups, so only these two can lie in another slice as well. Rows of
    a slice are in one bucket, so both aggregates run in place; beyond them there are two rows a slice.
    """
    per_group = rows.groupBy(*keys, _SLICE).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    end = F.struct(_group(keys).alias("_k"), *sums)
    ends = per_group.groupBy(_SLICE).agg(F.min(end).alias("_a"), F.max(end).alias("_b"))
    ends = ends.select(_SLICE, F.explode(F.array_distinct(F.array("_a", "_b"))).alias("_e"))
    ends = ends.select(_SLICE, "_e._k", *[f"_e._k.{k}" for k in keys], *[f"_e.{n}" for n in sums])
    before = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    ends = ends.select(
        F.col(_SLICE).alias("_at"),
        F.struct(
            "_k", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias("_o_" + n) for n in sums],
            *[F.sum(n).over(whole).alias("_t_" + n) for n in sums],
        ).alias("_e"),
    )
    return ends.groupBy("_at").agg(F.min("_e").alias("_a"), F.max("_e").alias("_b"))


def _lifted(rows: DataFrame, keys: Sequence[str], sums: dict[str, Column], lifts: dict[str, Column],
            totals: dict[str, str]) -> DataFrame:
    """Add to each column of ``lifts`` the sum of earlier slices, and each column of ``totals`` as its group's whole sum."""
    edges = _edges(rows, keys, sums).hint("shuffle_hash")
    first, last = _group(keys).eqNullSafe(F.col("_a._k")), _group(keys).eqNullSafe(F.col("_b._k"))
    here = Window.partitionBy(*keys, _SLICE)
    return rows.join(edges, rows[_SLICE] == edges["_at"]).withColumns({
        **{n: c + F.when(first, F.col(f"_a._o_{n}")).otherwise(F.lit(0)) for n, c in lifts.items()},
        **{out: F.when(first, F.col(f"_a._t_{n}")).when(last, F.col(f"_b._t_{n}")).otherwise(F.sum(sums[n]).over(here))
           for out, n in totals.items()},
    })


def row_rank(df: DataFrame, keys: Sequence[str], order: Order, out: str,
             rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """1-based position of each row in its group; ``order`` must be unique in a group."""
    keys = list(keys)
    sliced = _sliced(df, keys, order, df.count(), rows_per_task)
    within = Window.partitionBy(*keys, _SLICE).orderBy(*_sort(order))
    ranked = _lifted(sliced, keys, {out: F.lit(1)}, {out: F.row_number().over(within)}, {})
    return ranked.select(*df.columns, F.col(out).cast("long").alias(out))


def running_sums(df: DataFrame, keys: Sequence[str], order: Order, sums: dict[str, str],
                 totals: dict[str, str] | None = None,
                 rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Inclusive running sums along ``order`` plus group totals.

    Meant for frames already aggregated to one row per (keys, order). The frame is
    staged first, so its upstream runs only once.
    """
    keys, totals = list(keys), totals or {}
    staged, rows = stage_counted(df, "counts")
    sliced = _sliced(staged, keys, order, rows, rows_per_task)
    within = (
        Window.partitionBy(*keys, _SLICE).orderBy(*_sort(order)).rowsBetween(Window.unboundedPreceding, 0)
    )
    all_sums = {n: F.col(c) for n, c in {**sums, **{"_all_" + n: c for n, c in totals.items()}}.items()}
    lifts = {n: F.sum(F.col(c)).over(within) for n, c in sums.items()}
    return _lifted(sliced, keys, all_sums, lifts, {n: "_all_" + n for n in totals}).select(*df.columns, *sums, *totals)


def quantiles_from_counts(counts: DataFrame, keys: Sequence[str], value: str, n: str,
                          probs: Sequence[float], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Exact linear-interpolated quantiles from (keys, value, n); one array per key.

    Reads positions off the running counts, so no task holds a group's values.
    """
    keys = list(keys)
    cum = running_sums(
        counts.filter(F.col(value).isNotNull() & (F.col(n) > 0)).select(*keys, value, n),
        keys, [(value, "asc")], {"_cum": n}, {"_all": n}, rows_per_task,
    )

    return _read_off(cum, keys, probs, f"`{value}`")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                    rows_per_task: int = ROWS_PER_TASK, many_groups: bool = False) -> DataFrame:
    """Exact quantiles of ``value`` per group as an array in the order of ``probs``.

    A sketch first brackets each quantile. Values outside every bracket are then only
    counted, so map-side aggregation leaves a fraction of a percent of the rows to
    shuffle and order. A bracket that missed shows as a gap and sends the work down the
    plain way, which counts every distinct value. ``many_groups`` takes that way at
    once; it suits groups of few rows each.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
    if not many_groups:
        found = _bracketed(rows, keys, probs, rows_per_task)
        if not found.filter(F.exists("quantiles", F.isnull)).limit(1).count():
            return found
    counts = rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    return quantiles_from_counts(counts, keys, "_v", "_n", probs, rows_per_task)


SKETCH_ACCURACY = 10_000


def _bracketed(rows: DataFrame, keys: list[str], probs: Sequence[float], rows_per_task: int) -> DataFrame:
    """Quantiles from bracketed counts; null where a bracket missed. The brackets are one row per group."""
    margin = 3.0 / SKETCH_ACCURACY
    ends = [min(1.0, max(0.0, p + way * margin)) for p in probs for way in (-1, 1)]
    at = ", ".join(f"{e!r}D" for e in ends)
    cuts = [f"_c{i}" for i in range(len(ends))]
    sketch = rows.groupBy(*keys).agg(F.expr(f"percentile_approx(_v, array({at}), {SKETCH_ACCURACY})").alias("_q"))
    # Written, so that Spark knows the table's size when it picks the join.
    brackets = stage(
        sketch.selectExpr(*[f"`{k}` as `_k_{k}`" for k in keys], *[f"_q[{i}] as {c}" for i, c in enumerate(cuts)]), "brackets"
    )
    joined = rows.join(brackets, _same(rows, brackets, keys))
    # Even places lie between two neighbouring cuts, odd places on one.
    place = " + ".join(f"int({c} < _v) + int({c} <= _v)" for c in cuts)
    inside = " or ".join(f"_v between {low} and {high}" for low, high in zip(cuts[::2], cuts[1::2]))
    cells = joined.select(
        *keys, F.expr(place).alias("_place"), F.expr(f"case when {inside} then _v end").alias("_x")
    ).groupBy(*keys, "_place", "_x").agg(F.count(F.lit(1)).alias("_n"))
    cum = running_sums(cells, keys, [("_place", "asc"), ("_x", "asc")], {"_cum": "_n"}, {"_all": "_n"}, rows_per_task)
    return stage(_read_off(cum, keys, probs, "struct(_place, _x)", "._x"), "quantiles")


def _read_off(cum: DataFrame, keys: list[str], probs: Sequence[float], cell: str, value: str = "") -> DataFrame:
    """Interpolated quantiles from running counts ``_cum`` of ``_all`` along rising cells.

    ``cell`` orders the cells and ``value`` reads the value off one. The expressions are
    SQL text, since there are several per quantile.
    """
    parts, picked = [], []
    for i, p in enumerate(probs):
        place = f"((_all - 1) * {float(p)!r}D)"
        parts += [
            F.expr(f"min(case when _cum > floor({place}) then {cell} end)").alias(f"_lo{i}"),
            F.expr(f"min(case when _cum > ceil({place}) then {cell} end)").alias(f"_hi{i}"),
            F.expr(f"max({place} - floor({place}))").alias(f"_w{i}"),
        ]
        picked.append(f"_lo{i}{value} + (_hi{i}{value} - _lo{i}{value}) * _w{i}")
    return cum.groupBy(*keys).agg(*parts).selectExpr(
        *[f"`{k}`" for k in keys], f"array({', '.join(picked)}) as quantiles"
    )
