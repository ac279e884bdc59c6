"""Rate-within-group analysis.

Only the rate inside a group, against the base rate, says anything about risk; the
shares describe volume. Each table aggregates map-side before its one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType

from finsieve.constants import BANK_MIN_SUPPORT, SEED, TARGET, VELOCITY_BANDS, VISUAL_SAMPLE_ROWS
from finsieve.functions.columns import velocity_band
from finsieve.operators.ordered import exact_quantiles
from finsieve.operators.prep import first_by_hash
from finsieve.session import stage


def group_rate(df: DataFrame, key: str, label: str = TARGET) -> DataFrame:
    """(key, n, n_illicit, rate, pct_of_tx, pct_of_illicit, lift).

    The totals are summed from the per-group counts, so the table is read once; they
    are two numbers and travel as literals.
    """
    counts = stage(
        df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("n_illicit")),
        "rates",
    )
    rows, illicit = counts.agg(F.sum("n"), F.sum("n_illicit")).first()
    return with_rates(counts, rows, illicit)


def with_rates(counts: DataFrame, rows: int | None, illicit: int | None) -> DataFrame:
    n, bad = F.col("n"), F.col("n_illicit")
    rows, illicit = F.lit(rows).cast("double"), F.lit(illicit).cast("double")
    base = illicit / F.nullif(rows, F.lit(0.0))
    rate = bad / F.nullif(n, F.lit(0))
    return counts.withColumns({
        "rate": rate,
        "pct_of_tx": 100.0 * n / F.nullif(rows, F.lit(0.0)),
        "pct_of_illicit": 100.0 * bad / F.nullif(illicit, F.lit(0.0)),
        "lift": rate / F.nullif(base, F.lit(0.0)),
    })


def velocity_rates(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Rates over the velocity bands; a band nobody falls into keeps a row."""
    found = group_rate(df.withColumn("band", velocity_band()), "band", label)
    bands = df.sparkSession.createDataFrame([(b,) for b in VELOCITY_BANDS], "band string")
    zero = {"n": 0, "n_illicit": 0, "pct_of_tx": 0.0, "pct_of_illicit": 0.0}
    return bands.join(found, "band", "left").na.fill(zero)


def format_table(df: DataFrame) -> DataFrame:
    """Illicit and legitimate rate per payment format, highest rate first."""
    return (
        group_rate(df, "payment_format")
        .withColumns({"illicit_rate_pct": 100.0 * F.col("rate"), "legit_rate_pct": 100.0 - 100.0 * F.col("rate")})
        .orderBy(F.desc("rate"), "payment_format")
    )


def bank_rates(df: DataFrame, min_support: int = BANK_MIN_SUPPORT, top: int = 10) -> DataFrame:
    """The banks with the highest rate among those with enough payments."""
    return (
        group_rate(df, "from_bank").filter(F.col("n") >= min_support)
        .orderBy(F.desc("rate"), "from_bank").limit(top)
    )


def bank_spread(df: DataFrame, min_support: int = BANK_MIN_SUPPORT, label: str = TARGET) -> DataFrame:
    """Sending banks in all, with support, and with at least one illicit payment."""
    banks = df.groupBy("from_bank").agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("bad"))
    return banks.agg(
        F.count(F.lit(1)).alias("n_banks"),
        F.count_if(F.col("n") >= min_support).alias("n_supported"),
        F.count_if(F.col("bad") > 0).alias("n_with_illicit"),
    )


def illicit_entities(df: DataFrame, label: str = TARGET) -> DataFrame:
    return df.filter(F.col(label) == 1).agg(
        F.count(F.lit(1)).alias("n_illicit"),
        F.count_distinct("account").alias("n_senders"),
        F.count_distinct("counterparty").alias("n_receivers"),
    )


def contingency(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """(rows, columns, n): counts of each value of ``rows`` with each of ``columns`` that occurs, 0 where the two do not meet; null is a value.

    ``rows`` is a column of few values, such as a flag; ``columns`` may have any number.
    """
    counts = stage(df.groupBy(rows, columns).agg(F.count(F.lit(1)).alias("n")), "counts")
    kind = counts.schema[rows].dataType
    values = F.array(*[F.lit(r[0]).cast(kind) for r in counts.select(rows).distinct().collect()]).cast(ArrayType(kind))
    cells = counts.select(F.col(columns).alias("_c")).distinct().select("_c", F.explode(values).alias("_r"))
    met = F.col("_c").eqNullSafe(F.col(columns)) & F.col("_r").eqNullSafe(F.col(rows))
    return cells.join(counts, met, "left").select(F.col("_r").alias(rows), F.col("_c").alias(columns), F.coalesce("n", F.lit(0)).alias("n"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix as (i, j, r), every pair from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    one_row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    cells = [(a, a, F.lit(1.0)) for a in columns]
    for a, b in pairs:
        cells += [(a, b, F.col(f"`{a}|{b}`")), (b, a, F.col(f"`{a}|{b}`"))]
    return one_row.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("i"), F.lit(b).alias("j"), r.alias("r")) for a, b, r in cells
    ])).alias("c")).select("c.*")


def class_quartiles(df: DataFrame, value: str, label: str = TARGET) -> DataFrame:
    """Box-plot numbers per class."""
    ends = df.groupBy(label).agg(F.count(value).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"))
    mid = exact_quantiles(df, [label], value, (0.25, 0.5, 0.75))
    return ends.join(mid, label).select(
        label, "n", "min", *[F.col("quantiles")[i].alias(q) for i, q in enumerate(("p25", "p50", "p75"))], "max"
    )


def class_histogram(df: DataFrame, value: Column, bins: int, label: str = TARGET) -> DataFrame:
    """Density histogram per class over that class's own range, as a plot would bin it.

    A class with any value has all its bins, empty ones with a count of 0. Labels other than 0 and 1 are
    no class.
    """
    rows = df.select(label, value.alias("x")).filter(F.col(label).isin(0, 1))
    ends = rows.agg(*[
        f(F.when(F.col(label) == cls, F.col("x"))).alias(f"{name}{cls}")
        for cls in (0, 1) for name, f in (("lo", F.min), ("hi", F.max), ("n", F.count))
    ]).first()
    lo = width = total = F.lit(None).cast("double")
    for cls in (0, 1):
        if not ends[f"n{cls}"]:
            continue
        low, high = ends[f"lo{cls}"], ends[f"hi{cls}"]
        if low == high:
            low, high = low - 0.5, high + 0.5
        here = F.col(label) == cls
        lo = F.when(here, F.lit(float(low))).otherwise(lo)
        width = F.when(here, F.lit((high - low) / bins)).otherwise(width)
        total = F.when(here, F.lit(float(ends[f"n{cls}"]))).otherwise(total)
    spot = F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1)).cast("int")
    counts = rows.filter(F.col("x").isNotNull()).groupBy(label, spot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    known = [cls for cls in (0, 1) if ends[f"n{cls}"]]
    every = spark.createDataFrame([(c, b) for c in known for b in range(bins)], "_label int, bin int")
    every = every.select(F.col("_label").cast(df.schema[label].dataType).alias(label), "bin")
    return every.join(counts, [label, "bin"], "left").na.fill(0, ["n"]).withColumn("density", F.col("n") / (total * width))


def visual_sample(df: DataFrame, n: int = VISUAL_SAMPLE_ROWS, seed: int = SEED, label: str = TARGET) -> DataFrame:
    """Every illicit row plus ``n`` legitimate rows drawn by hash order."""
    legit = F.col(label) == 0
    return df.filter((F.col(label) == 1) | (legit & first_by_hash(df.filter(legit), n, seed)))
