"""Streaming jobs: late rows, replays, repeated rows, closed windows."""

import pytest
from pyspark.sql import functions as F

from finsieve.operators.features import add_prior_count
from finsieve.plans import catalog_monitoring
from finsieve.streaming import jobs

SCHEMA = "row_id long, account string, ts timestamp"


def batch(spark, rows):
    return spark.createDataFrame(rows, "row_id long, account string, ts string").withColumn("ts", F.to_timestamp("ts"))


def day(d, h=0):
    return f"2024-01-{d:02d} {h:02d}:00:00"


@pytest.fixture
def state(spark, tmp_path):
    return jobs.PriorCountState(spark, str(tmp_path / "state"), compact_every=2)


def counts(state):
    return {r.row_id: r.sender_previous_tx_count for r in jobs.counted(state).collect()}


def test_out_of_order_rows_within_the_delay(spark, state):
    jobs.count_batch(state, batch(spark, [(1, "A", day(1)), (3, "A", day(3)), (4, "B", day(2))]), 0, "2 days")
    jobs.count_batch(state, batch(spark, [(2, "A", day(2)), (5, "A", day(6)), (2, "A", day(2))]), 1, "2 days")
    jobs.count_batch(state, batch(spark, [(6, "A", day(9)), (5, "A", day(6))]), 2, "2 days")
    jobs.close_prior_count(state, batch(spark, []), 3)
    assert counts(state) == {1: 0, 2: 1, 3: 2, 4: 0, 5: 3, 6: 4}


def test_late_rows_are_set_aside(spark, state):
    jobs.count_batch(state, batch(spark, [(1, "A", day(1)), (2, "A", day(9))]), 0, "1 day")
    jobs.count_batch(state, batch(spark, [(3, "A", day(2)), (4, "A", day(12))]), 1, "1 day")
    jobs.close_prior_count(state, batch(spark, []), 2)
    assert counts(state) == {1: 0, 2: 1, 4: 2}
    late = spark.read.parquet(f"{state.path}/late").collect()
    assert [r.row_id for r in late] == [3]


def test_replayed_batch_changes_nothing(spark, state):
    first = batch(spark, [(1, "A", day(1)), (2, "A", day(2)), (3, "A", day(5))])
    second = batch(spark, [(4, "A", day(6)), (5, "B", day(6))])
    for rows, n in ((first, 0), (first, 0), (second, 1), (second, 1)):
        jobs.count_batch(state, rows, n, "1 day")
    jobs.close_prior_count(state, batch(spark, []), 2)
    jobs.close_prior_count(state, batch(spark, []), 2)
    assert counts(state) == {1: 0, 2: 1, 3: 2, 4: 3, 5: 0}


def test_stream_equals_batch(spark, state, signal, tmp_path):
    rows = signal.select("row_id", "account", "ts").filter("row_id % 10 = 0")
    path = str(tmp_path / "in")
    for i in range(3):
        rows.filter((F.col("row_id") >= i * 20000) & (F.col("row_id") < (i + 1) * 20000)).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    run = jobs.prior_count_stream(stream, state, str(tmp_path / "ck"), "12 hours", rows_per_task=100)
    run.awaitTermination()
    jobs.close_prior_count(state, rows.limit(0), run.lastProgress["batchId"] + 1)
    want = {r.row_id: r.sender_previous_tx_count for r in add_prior_count(rows).collect()}
    assert counts(state) == want and len(want) == 6000


def test_per_minute_emits_closed_windows(spark, tmp_path):
    rows = spark.sql("""select timestamp'2024-01-01' + make_interval(0,0,0,0,0,0,id * 20) as ts, if(id % 5 = 0, '5xx', '2xx') as status_class,
                        double(id) as latency_ms from range(180)""")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = jobs.per_minute_stream(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "10 minutes")
    q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck"))
    q.trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.agg(F.max("minute")).first()[0].minute == 48 and out.agg(F.sum("requests")).first()[0] == 49 * 3
    first = out.filter("status_class = '2xx'").orderBy("minute").first()
    assert (first.requests, first.latency_mean, first.latency_p50) == (2, 1.5, 1.0)


def test_slices_are_as_many_files_as_triggers_count(spark, monkeypatch):
    for n, most, want in ((300, 1_000_000, 1), (400_000, 1_000_000, 1), (400_000, 100_000, 5)):
        monkeypatch.setattr(catalog_monitoring, "ROWS_A_FILE", most)
        rows = spark.range(n).select(F.col("id").alias("row_id"), F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, int(id % 6))").alias("ts"),
                                     F.expr("concat(md5(string(id)), md5(string(id + 1)), md5(string(id + 2)))").alias("note"))
        path, files = catalog_monitoring.arrivals(spark, rows, "arrivals")
        back = spark.read.parquet(path)
        assert back.exceptAll(rows).count() == 0 and back.count() == n
        assert files == want and len(back.inputFiles()) == 2 * files  # two slices of three days
