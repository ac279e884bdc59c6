"""Telemetry collections: JSON lines of ``{"correlationid": ..., "data": [ {one row} ]}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from finsieve.constants import REQUEST_NAMES

COLLECTIONS = ("inputs", "outputs")


def scan_envelopes(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Read ``path/inputs`` and ``path/outputs``, one record per non-blank line.

    ``row`` is null unless ``data`` is a list of exactly one object; ``correlationid``
    is null unless it is a non-empty string. ``position`` orders the lines of a file:
    lines of one split keep their order in the running id. Text that is not a JSON
    object fails the job naming its file, or is left out when not strict.
    """
    both = None
    for collection in COLLECTIONS:
        lines = spark.read.text(f"{path}/{collection}", recursiveFileLookup=True).select(
            F.lit(collection).alias("collection"),
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("line"),
            ).alias("position"),
            F.when(F.col("value").startswith("\uFEFF"), F.expr("substring(value, 2)")).otherwise(F.col("value")).alias("value"),
        )
        both = lines if both is None else both.unionByName(lines)
    both = both.filter(F.trim("value") != "")
    # Parsed as the one element of an array, and the id below too: filters, which Spark moves below projections, would each parse again.
    both = both.select("collection", "position", "value", F.explode(F.array(F.try_parse_json("value"))).alias("v"))
    # Text that parses and opens with a brace is an object.
    is_object = F.col("v").isNotNull() & F.ltrim("value").startswith("{")
    if strict:
        stop = F.raise_error(F.concat(F.lit("not a JSON object in "), F.col("position.file"))).cast("boolean")
        both = both.filter(F.when(is_object, F.lit(True)).otherwise(stop))
    else:
        both = both.filter(is_object)
    cid = F.try_variant_get("v", "$.correlationid", "variant")
    text = F.try_variant_get("v", "$.correlationid", "string")
    proper = (F.schema_of_variant(cid) == "STRING") & (text != "")
    items = F.try_variant_get("v", "$.data", "array<variant>")
    row = F.try_variant_get("v", "$.data[0]", "map<string,variant>")
    one = F.size(items) == 1
    both = both.select("collection", "position", "v", F.explode(F.array(F.when(proper, text))).alias("correlationid"))
    return both.select(
        "collection", "position", "correlationid",
        F.when(one, row).alias("row"),
        F.when(one & row.isNotNull(), F.to_json(F.try_variant_get("v", "$.data[0]", "variant"))).alias("row_json"),
    )


def correlation_id(row_id: str = "row_id") -> Column:
    """An id that a replay repeats."""
    return F.md5(F.concat(F.lit("request-"), F.col(row_id).cast("string")))


def input_envelope(cid: Column) -> Column:
    row = F.struct(*[F.col(c).alias(name) for c, name in REQUEST_NAMES.items()])
    return F.to_json(F.struct(cid.alias("correlationid"), F.array(row).alias("data")))


def output_envelope(cid: Column) -> Column:
    row = F.struct(
        F.col("risk_score").alias("score"), F.col("is_alert").alias("alert"), "threshold", "model_version"
    )
    return F.to_json(F.struct(cid.alias("correlationid"), F.array(row).alias("data")))


ROWS_PER_FILE = 1_000_000


def emit(scored: DataFrame, path: str, rate: float = 1.0, mode: str = "append",
         rows_per_file: int = ROWS_PER_FILE) -> None:
    """Append scored rows as paired collections, rolled by event hour.

    Sampling is by id, so both records of a request are kept or neither is. Each hour is
    written by one task, except that an hour beyond ``rows_per_file`` is salted over as
    many tasks as it needs.
    """
    spark, cid, hours = scored.sparkSession, correlation_id(), ["event_date", "event_hour"]
    if rate < 1.0:
        scored = scored.filter(F.substring(cid, 1, 8) < F.lit(f"{round(rate * 0x1_0000_0000):08x}"))
    rolled = scored.withColumns({"event_date": F.to_date("ts"), "event_hour": F.hour("ts")})
    counts = rolled.groupBy(*hours).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_file)
    busy = counts.collect()  # at most rows / rows_per_file
    salt = F.lit(0)
    if busy:
        rolled = rolled.join(F.broadcast(spark.createDataFrame(busy, counts.schema)), hours, "left")
        parts = F.ceil(F.coalesce(F.col("_n"), F.lit(1)) / F.lit(rows_per_file))
        salt = F.pmod(F.xxhash64("row_id"), parts)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = rolled.withColumn("_salt", salt).repartition(tasks, *hours, "_salt")
    for collection, envelope in zip(COLLECTIONS, (input_envelope, output_envelope)):
        spread.select(envelope(cid).alias("value"), *hours).write.mode(mode).partitionBy(*hours).text(
            f"{path}/{collection}"
        )
