"""Leakage-safe features: nothing here reads the target or a later row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from finsieve.constants import MODEL_FEATURES
from finsieve.functions.columns import business_hours, flag_equal, hour_of
from finsieve.operators.ordered import ROWS_PER_TASK, row_rank


def add_temporal(df: DataFrame) -> DataFrame:
    return df.withColumns({"hour": hour_of(), "is_business_hours": business_hours()})


def add_same_account(df: DataFrame) -> DataFrame:
    return df.withColumn("same_account", flag_equal("account", "counterparty"))


def add_prior_count(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """How many earlier payments the sender made, by (ts, row_id); the first gets 0."""
    ranked = row_rank(df, ["account"], [("ts", "asc"), ("row_id", "asc")], "_rank", rows_per_task)
    return ranked.withColumn("sender_previous_tx_count", F.col("_rank") - 1).drop("_rank")


def add_account_days(df: DataFrame) -> DataFrame:
    """Distinct active days of the sender, and whether there was only one.

    Days are first reduced to one row per (account, day), so a busy account reaches
    the second aggregate as at most one row per calendar day.
    """
    days = (
        df.select("account", F.to_date("ts").alias("day")).distinct()
        .groupBy("account").agg(F.count("day").alias("account_n_days"))
    )
    return df.join(days, "account").withColumn(
        "single_day_account", (F.col("account_n_days") == 1).cast("int")
    )


def build_features(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """All five model features next to the input columns."""
    return add_prior_count(add_same_account(add_temporal(df)), rows_per_task)


def model_features(df: DataFrame, narrow: bool = False, keep: tuple[str, ...] = ("row_id",),
                   rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Exactly the five model columns, after ``keep``; rows are preserved."""
    needed = ["row_id", "ts", "account", "counterparty", "amount_paid", "payment_format"]
    source = df.select(*dict.fromkeys([*needed, *[k for k in keep if k in df.columns]]))
    out = build_features(source, rows_per_task).select(*keep, *MODEL_FEATURES)
    if not narrow:
        return out
    return out.withColumns({
        "amount_paid": F.col("amount_paid").cast("float"),
        "sender_previous_tx_count": F.col("sender_previous_tx_count").cast("int"),
        "is_business_hours": F.col("is_business_hours").cast("tinyint"),
        "same_account": F.col("same_account").cast("tinyint"),
    })
