"""Population-stability drift between a reference and current rows.

The reference is reduced once to a profile: quantile edges per numeric feature and a
count per (feature, bucket). Each monitoring run then reads current rows only.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, GroupedData, functions as F

from finsieve.constants import (
    BINARY_FEATURES, CATEGORICAL_FEATURES, NUMERIC_FEATURES, PSI_BINS, PSI_EPSILON, PSI_MODERATE,
    PSI_SIGNIFICANT,
)
from finsieve.operators.ordered import ROWS_PER_TASK, exact_quantiles
from finsieve.session import stage


class Profile(NamedTuple):
    edges: DataFrame    # feature, inner: the finite cut points, rising
    buckets: DataFrame  # feature, bucket, n_ref
    columns: dict[str, str]  # feature -> type
    bins: int


FEATURE_TYPES = {
    **dict.fromkeys(CATEGORICAL_FEATURES, "categorical"),
    **dict.fromkeys(NUMERIC_FEATURES, "numeric"),
    **dict.fromkeys(BINARY_FEATURES, "binary"),
}


def _numeric(kind: str) -> bool:
    return kind in ("numeric", "prediction")


def _melt(df: DataFrame, types: dict[str, str], keys: Sequence[str]) -> DataFrame:
    """(keys, feature, type, text, number): one row per feature, text for classes only."""
    def cell(name: str, kind: str) -> Column:
        if _numeric(kind):
            value = F.col(name).cast("double")
            missing = F.raise_error(F.lit(f"{name} must be numeric and present")).cast("double")
            text, number = F.lit(None).cast("string"), F.when(value.isNull(), missing).otherwise(value)
        else:
            text, number = F.coalesce(F.col(name).cast("string"), F.lit("<NA>")), F.lit(None).cast("double")
        return F.struct(
            F.lit(name).alias("feature"), F.lit(kind).alias("type"), text.alias("text"), number.alias("number")
        )

    cells = F.array(*[cell(name, kind) for name, kind in types.items()])
    return df.select(*keys, F.explode(cells).alias("m")).select(*keys, "m.*")


def _bin(inner: str, value: str, most: int) -> Column:
    """Number of the at most ``most`` cut points at or below the value: bins are [a, b)."""
    return F.expr(" + ".join(f"coalesce(int(get({inner}, {i}) <= {value}), 0)" for i in range(most)))


def quantile_edges(quantiles: Column) -> Column:
    """Finite cut points: the outer quantiles open up to infinity, a lone value stays as the only cut."""
    unique = F.array_distinct(quantiles)
    return F.when(F.size(unique) < 2, unique).otherwise(F.slice(unique, F.lit(2), F.size(unique) - 2))


def reference_profile(reference: DataFrame, types: dict[str, str] = FEATURE_TYPES, bins: int = PSI_BINS,
                      rows_per_task: int = ROWS_PER_TASK) -> Profile:
    """Edges from exact quantiles, then a count per bucket. ``reference`` should be a stored
    table: it is scanned for the edges and again for the counts, and little is shuffled.
    """
    numbers = {f: t for f, t in types.items() if _numeric(t)}
    probs = [i / bins for i in range(bins + 1)]
    if numbers:
        quantiles = exact_quantiles(_melt(reference, numbers, []), ["feature", "type"], "number", probs, rows_per_task)
    else:
        quantiles = reference.sparkSession.createDataFrame([], "feature string, type string, quantiles array<double>")
    edges = quantiles.select("feature", "type", quantile_edges(F.col("quantiles")).alias("inner"))
    found = _bucketed(reference, types, [], edges, bins).agg(F.count(F.lit(1)).alias("n_ref"))
    names = F.sequence(F.lit(0), F.size("inner")).cast("array<string>")
    every = edges.select("feature", F.explode(names).alias("bucket"))
    buckets = found.join(every, ["feature", "bucket"], "full_outer").na.fill({"n_ref": 0})
    return Profile(edges.select("feature", "inner"), stage(buckets, "buckets"), dict(types), bins)


def _bucketed(df: DataFrame, types: dict[str, str], keys: list[str], edges: DataFrame, bins: int) -> GroupedData:
    # One row per numeric column, so the broadcast side is bounded by the width of the table.
    cut = F.broadcast(edges.select(F.col("feature").alias("_f"), "inner"))
    melted = _melt(df, types, keys)
    melted = melted.join(cut, melted.feature == cut["_f"], "left")
    number = _bin("inner", "number", bins).cast("string")
    bucket = F.when(F.col("text").isNotNull(), F.col("text")).otherwise(number)
    return melted.groupBy(*keys, "feature", bucket.alias("bucket"))


def bucket_counts(profile: Profile, current: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, feature, bucket, n_cur) of current rows in the profile's buckets."""
    grouped = _bucketed(current, profile.columns, list(keys), profile.edges, profile.bins)
    return grouped.agg(F.count(F.lit(1)).alias("n_cur"))


def classify_psi(psi: str = "psi") -> Column:
    return (
        F.when(F.col(psi) < PSI_MODERATE, F.lit("low"))
        .when(F.col(psi) < PSI_SIGNIFICANT, F.lit("moderate")).otherwise(F.lit("significant"))
    )


def drift_report(profile: Profile, current: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """PSI and signal of every feature, per ``keys`` (monitoring windows) if given.

    Counts are smoothed before they are normalised. Only buckets that a window holds are
    joined, on (feature, bucket); those of the reference that it lacks all have the same
    current share, so their part follows from four sums per feature over the reference.
    """
    keys = list(keys)
    by = [*keys, "feature"]
    r = F.col("n_ref") + PSI_EPSILON
    sums = {"n": F.lit(1), "r": r, "l": F.log(r), "rl": r * F.log(r)}
    # One row per feature.
    whole = profile.buckets.groupBy("feature").agg(*[F.sum(c).alias(f"t_{n}") for n, c in sums.items()], F.sum("n_ref").alias("all_ref"))
    counts = bucket_counts(profile, current, keys)
    present = stage(counts.join(profile.buckets.select("feature", "bucket", "n_ref"), ["feature", "bucket"], "left"), "current")
    known = F.col("n_ref").isNotNull()
    totals = present.groupBy(*by).agg(
        F.sum("n_cur").alias("all_cur"), F.count_if(~known).alias("n_new"),
        *[F.coalesce(F.sum(F.when(known, c)), F.lit(0.0)).alias(f"p_{n}") for n, c in sums.items()],
    ).join(whole, "feature", "left").na.fill(0)
    totals = totals.withColumn("bucket_count", F.col("t_n") + F.col("n_new"))
    smoothed = PSI_EPSILON * F.col("bucket_count")
    all_ref, all_cur = F.col("all_ref") + smoothed, F.col("all_cur") + smoothed
    ref, cur = (F.coalesce("n_ref", F.lit(0)) + PSI_EPSILON) / all_ref, (F.col("n_cur") + PSI_EPSILON) / all_cur
    n, sr, sl, srl = (F.col(f"t_{x}") - F.col(f"p_{x}") for x in ("n", "r", "l", "rl"))
    least = PSI_EPSILON / all_cur
    lacking = least * (n * F.log(least * all_ref) - sl) - (sr * F.log(least * all_ref) - srl) / all_ref
    kind = F.lit(None).cast("string")
    for name, t in profile.columns.items():
        kind = F.when(F.col("feature") == name, F.lit(t)).otherwise(kind)
    return (
        present.join(totals, by).groupBy(*by).agg(
            (F.sum((cur - ref) * F.log(cur / ref)) + F.max(F.when(n > 0, lacking).otherwise(0.0))).alias("psi"),
            F.max("bucket_count").cast("long").alias("bucket_count"),
        )
        .withColumns({"type": kind, "signal": classify_psi()})
        .select(*keys, "feature", "type", "psi", "signal", "bucket_count")
    )


def save_profile(profile: Profile, path: str) -> None:
    """Write a profile; monitoring runs load it and never read the reference again."""
    profile.edges.write.mode("overwrite").parquet(f"{path}/edges")
    profile.buckets.write.mode("overwrite").parquet(f"{path}/buckets")
    spark = profile.edges.sparkSession
    columns = spark.createDataFrame([(c, t, profile.bins) for c, t in profile.columns.items()], "feature string, type string, bins int")
    columns.coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")  # one row per feature


def load_profile(spark: SparkSession, path: str) -> Profile:
    columns = spark.read.parquet(f"{path}/columns").collect()
    return Profile(
        spark.read.parquet(f"{path}/edges"), spark.read.parquet(f"{path}/buckets"),
        {r.feature: r.type for r in columns}, columns[0].bins,
    )


def drift_summary(report: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Overall signal and the drifting features in order. Prediction drift counts too."""
    def named(signal: str) -> Column:
        mine = (F.col("signal") == signal) & (F.col("type") != "prediction")
        return F.array_sort(F.collect_list(F.when(mine, F.col("feature"))))

    severity = F.when(F.col("signal") == "significant", 2).when(F.col("signal") == "moderate", 1).otherwise(0)
    return report.groupBy(*keys).agg(
        F.max(severity).alias("_s"), named("significant").alias("significant_features"),
        named("moderate").alias("moderate_features"),
        F.max(F.when(F.col("type") == "prediction", F.col("signal"))).alias("prediction_signal"),
    ).withColumn(
        "overall_signal",
        F.when(F.col("_s") == 2, F.lit("significant")).when(F.col("_s") == 1, F.lit("moderate")).otherwise(F.lit("low")),
    ).drop("_s")


def score_summary(scored: DataFrame, keys: Sequence[str], score: str = "score") -> DataFrame:
    """Mean, exact quantiles and ends of the scores per key."""
    ends = scored.groupBy(*keys).agg(
        F.count(score).alias("n"), F.avg(score).alias("mean"), F.min(score).alias("min"), F.max(score).alias("max")
    )
    names = ("p05", "p25", "median", "p75", "p95")
    q = exact_quantiles(scored, keys, score, (0.05, 0.25, 0.5, 0.75, 0.95))
    return ends.join(q, list(keys)).select(
        *keys, "n", "mean", "min", *[F.col("quantiles")[i].alias(x) for i, x in enumerate(names)], "max"
    )


def alert_rate_shift(reference: DataFrame, current: DataFrame, threshold: float) -> DataFrame:
    """Alert rates on both sides and the change in percentage points."""
    both = reference.select("score", F.lit(0).alias("side")).unionByName(current.select("score", F.lit(1).alias("side")))
    alert = (F.col("score") >= threshold).cast("double")
    return both.agg(
        F.avg(F.when(F.col("side") == 0, alert)).alias("reference_alert_rate"),
        F.avg(F.when(F.col("side") == 1, alert)).alias("current_alert_rate"),
    ).withColumn("change_pp", 100.0 * (F.col("current_alert_rate") - F.col("reference_alert_rate")))
