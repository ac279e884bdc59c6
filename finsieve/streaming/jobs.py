"""Streaming jobs: per-minute monitoring, continuous scoring, prior counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from finsieve.operators.features import add_prior_count
from finsieve.operators.ordered import ROWS_PER_TASK
from finsieve.sources.telemetry import emit


def per_minute_stream(requests: DataFrame, delay: str = "10 minutes", accuracy: int = 10_000) -> DataFrame:
    """Requests and latency per (minute, status class) for an append sink.

    Percentiles are sketches here, because streaming state must stay bounded.
    """
    p = F.percentile_approx("latency_ms", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)), accuracy)
    return (
        requests.withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 minute").alias("w"), "status_class")
        .agg(F.count(F.lit(1)).alias("requests"), F.avg("latency_ms").alias("latency_mean"), p.alias("p"))
        .select(
            F.col("w.start").alias("minute"), "status_class", "requests", "latency_mean",
            F.col("p")[0].alias("latency_p50"), F.col("p")[1].alias("latency_p95"), F.col("p")[2].alias("latency_p99"),
        )
    )


def _batch_dir(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def score_stream(features: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                 rate: float = 1.0) -> StreamingQuery:
    """Score a stream and collect paired telemetry under ``path``, rolled by event hour.

    Every micro-batch owns one folder and overwrites it, and ids derive from row_id, so
    a replayed batch leaves the same records.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        emit(score(batch), _batch_dir(path, batch_id), rate, mode="overwrite")

    return (
        features.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


class PriorCountState:
    """Tables of the streaming prior count, versioned by micro-batch.

    ``totals``  payments already counted, per account, as one delta per batch that is
                merged every ``compact_every`` batches;
    ``pending`` rows newer than the watermark, waiting for their order to be final;
    ``counted`` the output; ``late`` rows that arrived behind the watermark;
    ``mark``    the watermark each batch ended with.
    A batch reads the version before it and overwrites its own, so replays are exact.
    """

    def __init__(self, spark: SparkSession, path: str, compact_every: int = 10) -> None:
        self.spark, self.path, self.compact_every = spark, path, compact_every

    def at(self, table: str, version: int) -> str:
        return f"{self.path}/{table}/version={version}"

    def read(self, table: str, version: int, schema: str) -> DataFrame:
        if version < 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.at(table, version))

    def totals(self, version: int) -> DataFrame:
        """Counts per account after ``version``: the last merged table and the deltas since."""
        schema = "account string, n long"
        if version < 0:
            return self.spark.createDataFrame([], schema)
        first = version - version % self.compact_every
        paths = [self.at("totals", v) for v in range(first, version + 1)]
        parts = self.spark.read.schema(schema).parquet(*paths)
        return parts.groupBy("account").agg(F.sum("n").alias("n"))


MARK = "mark timestamp"


def count_batch(state: PriorCountState, batch: DataFrame, batch_id: int, delay: str, final: bool = False,
                rows_per_task: int = ROWS_PER_TASK) -> None:
    """Count the rows of one micro-batch whose order can no longer change.

    The watermark is the newest event time seen, less ``delay``. Rows behind the last
    watermark are late; rows up to the new one are counted in (ts, row_id) order on top
    of the account's total; the rest wait. Repeated deliveries of a waiting row_id are
    dropped.
    """
    state = PriorCountState(batch.sparkSession, state.path, state.compact_every)
    columns = batch.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema.fields)
    before = batch_id - 1
    last = state.read("mark", before, MARK).agg(F.max("mark")).first()[0]
    fresh = batch if last is None else batch.filter(F.col("ts") > F.lit(last))
    late = batch.limit(0) if last is None else batch.filter(F.col("ts") <= F.lit(last))
    late.write.mode("overwrite").parquet(state.at("late", batch_id))

    held = state.read("pending", before, schema)
    all_rows = held.unionByName(fresh).dropDuplicates(["row_id"])
    newest = all_rows.agg((F.max("ts") - F.expr(f"interval {delay}")).alias("m")).first()[0]
    if final:
        newest = all_rows.agg(F.max("ts")).first()[0]
    marks = [m for m in (last, newest) if m is not None]
    mark = max(marks) if marks else None
    ready = all_rows.filter(F.col("ts") <= F.lit(mark)) if mark is not None else all_rows.limit(0)
    waiting = all_rows.filter(F.col("ts") > F.lit(mark)) if mark is not None else all_rows

    waiting.write.mode("overwrite").parquet(state.at("pending", batch_id))
    done = state.totals(before).withColumnRenamed("n", "_done")
    counted = (
        add_prior_count(ready, rows_per_task).join(done, "account", "left")
        .withColumn("sender_previous_tx_count", F.col("sender_previous_tx_count") + F.coalesce("_done", F.lit(0)))
        .select(*columns, "sender_previous_tx_count")
    )
    counted.write.mode("overwrite").parquet(state.at("counted", batch_id))

    added = state.spark.read.parquet(state.at("counted", batch_id)).groupBy("account").agg(F.count(F.lit(1)).alias("n"))
    if batch_id % state.compact_every == 0:
        added = added.unionByName(state.totals(before)).groupBy("account").agg(F.sum("n").alias("n"))
    added.write.mode("overwrite").parquet(state.at("totals", batch_id))
    state.spark.createDataFrame([(mark,)], MARK).write.mode("overwrite").parquet(state.at("mark", batch_id))


def prior_count_stream(payments: DataFrame, state: PriorCountState, checkpoint: str, delay: str = "1 day",
                       rows_per_task: int = ROWS_PER_TASK) -> StreamingQuery:
    """Maintain the prior count over a stream of payments with a unique row_id and a ts."""
    def step(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        count_batch(state, batch, batch_id, delay, rows_per_task=rows_per_task)
        batch.unpersist()

    return (
        payments.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def close_prior_count(state: PriorCountState, empty: DataFrame, next_batch: int) -> None:
    """End of the stream: nothing more can arrive, so waiting rows are counted too."""
    count_batch(state, empty, next_batch, "0 seconds", final=True)


def counted(state: PriorCountState) -> DataFrame:
    """Everything counted so far."""
    return state.spark.read.parquet(f"{state.path}/counted").drop("version")


def collected_by_hour(spark: SparkSession, path: str) -> DataFrame:
    """Paired requests and alerts per event hour, read from the collected folders."""
    def lines(collection: str) -> DataFrame:
        text = spark.read.text(f"{path}/batch=*/{collection}", recursiveFileLookup=True)
        return text.select(
            F.get_json_object("value", "$.correlationid").alias("correlationid"),
            F.get_json_object("value", "$.data[0].alert").cast("boolean").alias("alert"),
            F.to_date(F.regexp_extract(F.col("_metadata.file_path"), "event_date=([0-9-]+)", 1)).alias("event_date"),
            F.regexp_extract(F.col("_metadata.file_path"), "event_hour=([0-9]+)", 1).cast("int").alias("event_hour"),
        )

    pairs = lines("inputs").select("correlationid").join(lines("outputs"), "correlationid")
    return pairs.groupBy("event_date", "event_hour").agg(F.count(F.lit(1)).alias("n"), F.count_if("alert").alias("alerts"))
