"""Auditing and pairing of collected scoring telemetry.

Records come from ``sources.telemetry.scan_envelopes`` with a ``collection`` column
of ``inputs`` or ``outputs``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from finsieve.constants import TELEMETRY_INPUT_FIELDS, TELEMETRY_OUTPUT_FIELDS
from finsieve.operators.ordered import exact_quantiles


def _field_set(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(n) for n in sorted(names)])


def _key() -> Column:
    """The id for a shuffle: hexadecimal text, as ids mostly are, as the bytes that it spells, other text as it is."""
    spelt = F.unhex("correlationid")
    return F.when(F.lower(F.hex(spelt)) == F.col("correlationid"), F.concat(F.lit(b"\x01"), spelt)).otherwise(
        F.concat(F.lit(b"\x00"), F.col("correlationid").cast("binary"))
    )


def _id(key: str) -> Column:
    """The id of a ``_key``."""
    rest = F.expr(f"substr({key}, 2)")
    return F.when(F.expr(f"substr({key}, 1, 1)") == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def _wrong_fields() -> Column:
    expected = F.when(F.col("collection") == "inputs", _field_set(TELEMETRY_INPUT_FIELDS)).otherwise(
        _field_set(TELEMETRY_OUTPUT_FIELDS)
    )
    return F.col("row").isNotNull() & (F.array_sort(F.map_keys("row")) != expected)


def per_id(records: DataFrame) -> DataFrame:
    """(collection, correlationid, records, invalid_shapes, schema_mismatches): one row per id, the missing id too.

    A much repeated id is counted before the shuffle and costs nothing.
    """
    counted = records.groupBy("collection", _key().alias("_key")).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("row").isNull()).alias("invalid_shapes"),
        F.count_if(_wrong_fields()).alias("schema_mismatches"),
    )
    return counted.select("collection", _id("_key").alias("correlationid"), "records", "invalid_shapes", "schema_mismatches")


def per_request(records: DataFrame) -> DataFrame:
    """(correlationid, and per side its records, invalid_shapes and schema_mismatches): one row per id, the missing id too.

    One shuffle by id serves both the counts of a side and the match of the sides.
    """
    counts = {"records": F.lit(True), "invalid_shapes": F.col("row").isNull(), "schema_mismatches": _wrong_fields()}
    names = [f"{side}_{c}" for side in ("inputs", "outputs") for c in counts]
    counted = records.groupBy(_key().alias("_key")).agg(*[
        F.count_if((F.col("collection") == side) & rows).alias(f"{side}_{c}") for side in ("inputs", "outputs") for c, rows in counts.items()
    ])
    return counted.select(_id("_key").alias("correlationid"), *names)


def audit(records: DataFrame) -> DataFrame:
    """Per collection: records, ids, duplicate ids, broken shapes and wrong field sets."""
    known = F.col("correlationid").isNotNull()

    def total(column: str, rows: Column = F.lit(True)) -> Column:
        return F.coalesce(F.sum(F.when(rows, F.col(column))), F.lit(0)).alias(column)

    return per_id(records).groupBy("collection").agg(
        total("records"), total("records", known).alias("valid_ids"), total("records", ~known).alias("missing_ids"),
        total("invalid_shapes"), total("schema_mismatches"), F.count_if(known & (F.col("records") > 1)).alias("duplicate_ids"),
    )


def pairing_audit(records: DataFrame) -> DataFrame:
    """Distinct ids on both sides, on the input side only and on the output side only."""
    return per_request(records).agg(*[n.alias(name) for name, n in _pairing().items()])


def _pairing() -> dict[str, Column]:
    """Counts of matched and one-sided ids over ``per_request``."""
    known, i, o = F.col("correlationid").isNotNull(), F.col("inputs_records") > 0, F.col("outputs_records") > 0
    return {"matched": F.count_if(known & i & o), "input_only": F.count_if(known & i & ~o), "output_only": F.count_if(known & o & ~i)}


def pair(records: DataFrame, strict: bool = True) -> DataFrame:
    """Inputs and outputs of each id; the last record of an id wins.

    One shuffle serves both the last-record rule and the full outer match; ids are packed for it. In strict
    mode a one-sided id or an invalid record fails the job; otherwise such rows drop out.
    """
    broken = F.col("correlationid").isNull() | F.col("row").isNull()
    if strict:
        stop = F.raise_error(F.lit("a telemetry record has no id or not exactly one row")).cast("string")
        records = records.withColumn("correlationid", F.when(broken, stop).otherwise(F.col("correlationid")))
    else:
        records = records.filter(~broken)

    def last(side: str) -> Column:
        return F.max_by("row_json", F.when(F.col("collection") == side, F.col("position")))

    both = records.groupBy(_key().alias("_key")).agg(last("inputs").alias("input"), last("outputs").alias("output"))
    both = both.select(_id("_key").alias("correlationid"), "input", "output")
    one_sided = F.col("input").isNull() | F.col("output").isNull()
    if not strict:
        return both.filter(~one_sided)
    stop = F.raise_error(F.lit("input and output ids do not match")).cast("string")
    return both.withColumn("input", F.when(one_sided, stop).otherwise(F.col("input")))


def typed_pairs(pairs: DataFrame) -> DataFrame:
    """Model features and score columns of paired records."""
    i = F.from_json("input", (
        "`Payment Format` string, `Amount Paid` double, sender_previous_tx_count long, "
        "is_business_hours int, same_account int"
    ))
    o = F.from_json("output", "score double, alert boolean, threshold double, model_version string")
    return pairs.select("correlationid", i.alias("i"), o.alias("o")).select(
        "correlationid", F.col("i.`Payment Format`").alias("payment_format"),
        F.col("i.`Amount Paid`").alias("amount_paid"), "i.sender_previous_tx_count",
        "i.is_business_hours", "i.same_account", "o.score", "o.alert", "o.threshold", "o.model_version",
    )


def acceptance_checks(records: DataFrame) -> DataFrame:
    """The ten acceptance checks in one row, the failing names, and PASS or FAIL."""
    c, known = F.col, F.col("correlationid").isNotNull()
    counts = _pairing()
    for side in ("inputs", "outputs"):
        n = c(f"{side}_records")
        counts[f"{side}_duplicate_ids"] = F.count_if(known & (n > 1))
        counts[f"{side}_missing_ids"] = F.coalesce(F.sum(F.when(~known, n)), F.lit(0))
        for name in ("records", "invalid_shapes", "schema_mismatches"):
            counts[f"{side}_{name}"] = F.coalesce(F.sum(f"{side}_{name}"), F.lit(0))
    row = per_request(records).agg(*[n.alias(name) for name, n in counts.items()])

    def clean(side: str) -> Column:
        return (c(f"{side}_invalid_shapes") == 0) & (c(f"{side}_schema_mismatches") == 0)

    checks = {
        "input_records_present": c("inputs_records") > 0,
        "output_records_present": c("outputs_records") > 0,
        "input_output_record_counts_match": c("inputs_records") == c("outputs_records"),
        "input_correlation_ids_unique": c("inputs_duplicate_ids") == 0,
        "output_correlation_ids_unique": c("outputs_duplicate_ids") == 0,
        "all_inputs_have_correlation_id": c("inputs_missing_ids") == 0,
        "all_outputs_have_correlation_id": c("outputs_missing_ids") == 0,
        "input_schema_valid": clean("inputs"),
        "output_schema_valid": clean("outputs"),
        "all_input_output_pairs_matched": (c("input_only") == 0) & (c("output_only") == 0),
    }
    failed = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in checks.items()]))
    return row.select(*[ok.alias(name) for name, ok in checks.items()], failed.alias("failed")).withColumn(
        "status", F.when(F.size("failed") == 0, F.lit("PASS")).otherwise(F.lit("FAIL"))
    )


def traffic_by_format(scored: DataFrame, threshold: float) -> DataFrame:
    """Requests, alerts and score ends per payment format."""
    alert = F.col("score") >= threshold
    return scored.groupBy("payment_format").agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(alert).alias("alerts"),
        F.avg(alert.cast("double")).alias("alert_rate"), F.avg("score").alias("score_mean"),
        F.min("score").alias("score_min"), F.max("score").alias("score_max"),
    )


def per_minute(requests: DataFrame) -> DataFrame:
    """Requests and latency per (minute, status class), with exact percentiles.

    Columns in: ts, status_class, latency_ms.
    """
    rows = requests.withColumn("minute", F.date_trunc("minute", "ts"))
    keys = ["minute", "status_class"]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("requests"), F.avg("latency_ms").alias("latency_mean"))
    q = exact_quantiles(rows, keys, "latency_ms", (0.5, 0.95, 0.99), many_groups=True)
    return counts.join(q, keys).select(
        *keys, "requests", "latency_mean",
        *[F.col("quantiles")[i].alias(x) for i, x in enumerate(("latency_p50", "latency_p95", "latency_p99"))],
    )
