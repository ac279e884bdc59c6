"""Schema contract, data-quality profile and scoring-domain rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from finsieve.constants import NUMERIC_CONTRACT, TARGET, TX_COLUMNS
from finsieve.operators.ordered import exact_quantiles
from finsieve.session import stage


class SchemaContractError(ValueError):
    """The ledger breaks its contract; the message names the columns."""


def missing_columns(df: DataFrame, required: Sequence[str] = TX_COLUMNS) -> list[str]:
    return [c for c in required if c not in df.columns]


def non_numeric_columns(df: DataFrame, columns: Sequence[str] = NUMERIC_CONTRACT) -> list[str]:
    return [c for c in columns if not isinstance(df.schema[c].dataType, NumericType)]


def target_offenders(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Known target values outside {0, 1}, with their counts."""
    return (
        df.filter(F.col(target).isNotNull() & ~F.col(target).isin(0, 1))
        .groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    )


def validate_ledger(df: DataFrame) -> DataFrame:
    """Presence, then binary target, then numeric types; the first failure raises."""
    missing = missing_columns(df)
    if missing:
        raise SchemaContractError(f"missing required columns: {', '.join(missing)}")
    bad = target_offenders(df).agg(F.count("*").alias("values"), F.sum("n").alias("rows"), F.min(TARGET).alias("low"), F.max(TARGET).alias("high")).first()
    if bad["values"]:
        raise SchemaContractError(
            f"{TARGET} must be 0 or 1; {bad.rows} rows hold {bad['values']} other values from {bad.low} to {bad.high}; "
            "target_offenders lists all"
        )
    wrong = non_numeric_columns(df)
    if wrong:
        raise SchemaContractError(f"columns must be numeric: {', '.join(wrong)}")
    return df


def contract_report(df: DataFrame) -> DataFrame:
    """One row per contract rule: rows looked at and rows that break it."""
    present = [c for c in TX_COLUMNS if c in df.columns]
    rules = [("presence:" + c, F.lit(0) if c in present else F.lit(1)) for c in TX_COLUMNS]
    if TARGET in present:
        bad = F.col(TARGET).isNotNull() & ~F.col(TARGET).isin(0, 1)
        rules.append(("binary:" + TARGET, bad.cast("int")))
    for c in NUMERIC_CONTRACT:
        if c in present:
            bad = F.col(c).isNotNull() & F.expr(f"try_cast({c} as double)").isNull()
            rules.append(("numeric:" + c, bad.cast("int")))
    totals = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(flag.cast("long")).alias(f"r{i}") for i, (_, flag) in enumerate(rules)],
    )
    return totals.select("rows", F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations"))
        for i, (name, _) in enumerate(rules)
    ])).alias("r")).select("r.rule", "rows", "r.violations")


def numeric_cast_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per text column: values present that are not numbers."""
    counts = df.agg(*[
        F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` as double)").isNull()).alias(c)
        for c in columns
    ])
    return counts.unpivot([], list(columns), "column_name", "n_failed")


def domain_reasons(df: DataFrame) -> DataFrame:
    """Add ``reasons``: the names of the scoring rules a row breaks."""
    return df.withColumn("reasons", F.array_compact(F.array(
        F.when(F.coalesce(F.col("amount_paid") < 0, F.lit(True)), F.lit("amount_negative")),
        F.when(F.coalesce(F.col("sender_previous_tx_count") < 0, F.lit(True)), F.lit("count_negative")),
        F.when(~F.coalesce(F.col("is_business_hours").isin(0, 1), F.lit(False)), F.lit("hours_flag")),
        F.when(~F.coalesce(F.col("same_account").isin(0, 1), F.lit(False)), F.lit("account_flag")),
        F.when(F.coalesce(F.trim("payment_format") == "", F.lit(True)), F.lit("format_blank")),
    )))


def split_by_domain(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows (format trimmed) and rejected rows (with reasons)."""
    checked = domain_reasons(df)
    accepted = checked.filter(F.size("reasons") == 0).drop("reasons")
    return (
        accepted.withColumn("payment_format", F.trim("payment_format")),
        checked.filter(F.size("reasons") > 0),
    )


def missing_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column, from one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return counts.unpivot(["_rows"], list(columns), "column_name", "n_missing").select(
        "column_name", "n_missing", (100.0 * F.col("n_missing") / F.col("_rows")).alias("pct_missing")
    )


def duplicate_count(df: DataFrame, columns: Sequence[str] = TX_COLUMNS) -> DataFrame:
    """Rows equal to an earlier row. Copies collapse map-side before the shuffle."""
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("n_duplicates")
    )


def timestamp_profile(df: DataFrame, text: str, fmt: str) -> DataFrame:
    """Parse failures and range of a timestamp held as text."""
    ts = F.try_to_timestamp(F.col(text), F.lit(fmt))
    return df.select(F.col(text).alias("_t"), ts.alias("_ts")).agg(
        F.count_if(F.col("_ts").isNull()).alias("n_failed"),
        F.min("_ts").alias("ts_min"), F.max("_ts").alias("ts_max"),
    )


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, min, exact quartiles and max per column.

    Columns are melted, so one pass gives the moments and one the quartiles.
    """
    melted = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns
    ])).alias("m")).select("m.*")
    moments = melted.groupBy("column_name").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(melted, ["column_name"], "value", (0.25, 0.5, 0.75))
    return moments.join(quartiles, "column_name").select(
        "column_name", "n", "mean", "std", "min",
        F.col("quantiles")[0].alias("p25"), F.col("quantiles")[1].alias("p50"),
        F.col("quantiles")[2].alias("p75"), "max",
    )


def cardinality(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column; the sketch is for very wide data."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "n_distinct"
    )


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Counts in falling order, ties by value; ``n`` keeps the head."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(column))
    return counts.limit(n) if n else counts


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Share of each value; the total is summed from the counts, so the table is read once."""
    counts = stage(df.groupBy(column).agg(F.count(F.lit(1)).alias("n")), "shares")
    total = counts.agg(F.sum("n")).first()[0]
    return counts.withColumn("pct", 100.0 * F.col("n") / F.lit(total))


def nonpositive_amounts(df: DataFrame, amount: str = "amount_paid") -> DataFrame:
    return df.agg(
        F.count_if(F.col(amount) <= 0).alias("n_nonpositive"), F.count(F.lit(1)).alias("n_rows")
    ).withColumn("pct_nonpositive", 100.0 * F.col("n_nonpositive") / F.col("n_rows"))
