"""Ranks, running sums and quantiles: the spread plans equal the plain ones."""

import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from finsieve.operators import ordered as o
from finsieve.operators.features import add_prior_count


@pytest.fixture(scope="module")
def skewed(spark):
    """One account with a third of all rows, most of them at one instant."""
    return spark.range(3000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 40)).alias("account"),
        F.when(F.col("id") % 4 != 0, F.lit("2024-01-01")).otherwise(
            F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 9).cast("int")), "yyyy-MM-dd")
        ).cast("timestamp").alias("ts"),
    ).cache()


def _pairs(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


@pytest.mark.parametrize("rows_per_task", [25, 200, 10_000])
def test_row_rank(skewed, rows_per_task):
    got = o.row_rank(skewed, ["account"], [("ts", "asc"), ("row_id", "desc")], "r", rows_per_task)
    w = Window.partitionBy("account").orderBy("ts", F.desc("row_id"))
    want = skewed.withColumn("r", F.row_number().over(w).cast("long"))
    assert _pairs(got, "row_id", "r") == _pairs(want, "row_id", "r")


def test_global_rank(skewed):
    got = o.row_rank(skewed, [], [("ts", "asc"), ("row_id", "asc")], "r", 100)
    want = skewed.withColumn("r", F.row_number().over(Window.orderBy("ts", "row_id")).cast("long"))
    assert _pairs(got, "row_id", "r") == _pairs(want, "row_id", "r")


def test_null_group(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "x") for i in range(60)], "row_id long, k string")
    got = o.row_rank(df, ["k"], [("row_id", "asc")], "r", 10)
    assert got.count() == 60
    assert got.filter("k is null").agg(F.max("r")).first()[0] == 30


@pytest.mark.parametrize("rows_per_task", [50, 10_000])
def test_prior_count_equals_self_join(skewed, rows_per_task):
    got = add_prior_count(skewed, rows_per_task)
    a, b = skewed.alias("a"), skewed.alias("b")
    earlier = (F.col("b.ts") < F.col("a.ts")) | ((F.col("b.ts") == F.col("a.ts")) & (F.col("b.row_id") < F.col("a.row_id")))
    want = a.join(b, (F.col("a.account") == F.col("b.account")) & earlier, "left").groupBy("a.row_id").agg(
        F.count("b.row_id").alias("n"))
    assert _pairs(got, "row_id", "sender_previous_tx_count") == _pairs(want, "row_id", "n")


def test_prior_count_micro(spark):
    rows = [(1, "A", "2024-01-01 00:00"), (2, "A", "2024-01-02 00:00"), (3, "B", "2024-01-01 00:00"),
            (4, "A", "2024-01-02 00:00"), (5, "B", "2024-01-03 00:00")]
    df = spark.createDataFrame(rows, "row_id long, account string, ts string").withColumn("ts", F.to_timestamp("ts"))
    got = {r.row_id: r.sender_previous_tx_count for r in add_prior_count(df).collect()}
    assert [got[i] for i in range(1, 6)] == [0, 1, 0, 2, 1]


@pytest.mark.parametrize("rows_per_task", [30, 10_000])
def test_running_sums(skewed, rows_per_task):
    counts = skewed.groupBy("account", "row_id").agg(F.count(F.lit(1)).alias("n"))
    got = o.running_sums(counts, ["account"], [("row_id", "desc")], {"cum": "n"}, {"all_n": "n"}, rows_per_task)
    w = Window.partitionBy("account").orderBy(F.desc("row_id"))
    want = counts.withColumns({"cum": F.row_number().over(w), "all_n": F.count("*").over(Window.partitionBy("account"))})
    assert _pairs(got, "account", "row_id", "cum", "all_n") == _pairs(want, "account", "row_id", "cum", "all_n")


PROBS = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)


@pytest.mark.parametrize("many", [False, True])
@pytest.mark.parametrize("rows_per_task", [20, 1_000_000])
def test_exact_quantiles(spark, many, rows_per_task):
    rng = random.Random(3)
    values = {"ties": [float(rng.randint(0, 4)) for _ in range(999)], "wide": [rng.lognormvariate(0, 3) for _ in range(500)],
              "one": [7.0], "same": [2.5] * 40}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs] + [("ties", None)], "k string, v double")
    got = {r.k: r.quantiles for r in o.exact_quantiles(df, ["k"], "v", PROBS, rows_per_task, many).collect()}
    for k, vs in values.items():
        assert np.allclose(got[k], np.quantile(vs, PROBS), rtol=1e-12, atol=1e-12), k


def test_quantiles_survive_a_coarse_sketch(spark, monkeypatch):
    """Brackets that miss are noticed and the result stays exact."""
    monkeypatch.setattr(o, "SKETCH_ACCURACY", 2)
    values = [float((i * 7919) % 5003) for i in range(5003)]
    df = spark.createDataFrame([(1, v) for v in values], "k int, v double")
    got = o.exact_quantiles(df, ["k"], "v", PROBS).first().quantiles
    assert np.allclose(got, np.quantile(values, PROBS))


def test_quantiles_of_many_groups(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("k"), F.col("id").cast("double").alias("v"))
    got = {r.k: r.quantiles[0] for r in o.exact_quantiles(df, ["k"], "v", (0.5,)).collect()}
    assert got == {k: 45.0 + k for k in range(10)}


def test_a_slice_stays_small(spark):
    """Few shuffle partitions do not make slices that a task cannot sort in memory."""
    rows = 4_000_000
    sliced = o._sliced(spark.range(rows), [], [("id", "asc")], rows, o.ROWS_PER_TASK)
    counts = [r[1] for r in sliced.groupBy(o._SLICE).count().collect()]
    assert sum(counts) == rows and max(counts) < 1.5 * o.ROWS_PER_TASK <= 400_000
