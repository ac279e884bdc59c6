"""Queries: telemetry, drift, streaming and monitoring policies."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from finsieve.operators import drift as dr, gates, models as md, ranking as rk, telemetry as tm
from finsieve.plans.catalog_ranking import REGRESSION
from finsieve.plans.registry import EV, EVF, FEAT, THRESHOLD, points, query
from finsieve.plans.views import (
    DRIFT_CUT, MISSING_DAY, ROW_NUMBER, SHIFT_FROM, SHIFT_TO, drift_current, drift_reference, features, prepared, rule_score, scored,
)
from finsieve.session import freeing, new_path, stage
from finsieve.sources import telemetry as src
from finsieve.streaming import jobs, policy


# --- telemetry --------------------------------------------------------------------


FILE_LINES = 250_000


def _write_defective(spark: SparkSession, sf: str) -> str:
    """Envelopes of the scored ledger with defects by ``ROW_NUMBER % 97``.

    1 no id, 2 empty id, 3 sent twice, 4 two data rows, 5 data is an object, 6 extra field,
    7 missing field, 8 input only, 9 output only, 10 leading byte-order mark, 11 a blank
    line before, 12 numeric id.
    """
    rows = md.with_contract(features(spark, sf), rule_score("rule_a"), THRESHOLD).withColumn("d", F.expr(f"{ROW_NUMBER} % 97"))
    cid = src.correlation_id()
    names = src.REQUEST_NAMES
    cells = [F.col(c).alias(n) for c, n in names.items()]
    again = [
        (F.col(c) + 1000).alias(n) if c == "sender_previous_tx_count" else F.col(c).alias(n) for c, n in names.items()
    ]
    row, second = F.to_json(F.struct(*cells)), F.to_json(F.struct(*again))
    extra, lacking = F.to_json(F.struct(*cells, F.lit(1).alias("extra"))), F.to_json(F.struct(*cells[:-1]))

    def listed(*texts) -> F.Column:
        return F.concat(F.lit("["), F.concat_ws(",", *texts), F.lit("]"))

    data = (
        F.when(F.col("d") == 4, listed(row, row)).when(F.col("d") == 5, row)
        .when(F.col("d") == 6, listed(extra)).when(F.col("d") == 7, listed(lacking)).otherwise(listed(row))
    )
    quoted = F.concat(F.lit('"correlationid":"'), cid, F.lit('",'))
    ident = (
        F.when(F.col("d") == 1, F.lit("")).when(F.col("d") == 2, F.lit('"correlationid":"",'))
        .when(F.col("d") == 12, F.lit('"correlationid":12,')).otherwise(quoted)
    )

    def line(d: F.Column) -> F.Column:
        return F.concat(F.lit("{"), ident, F.lit('"data":'), d, F.lit("}"))

    lines = (
        F.when(F.col("d") == 3, F.array(line(data), line(listed(second))))
        .when(F.col("d") == 10, F.array(F.concat(F.lit("﻿"), line(data))))
        .when(F.col("d") == 11, F.array(F.lit(""), line(data))).otherwise(F.array(line(data)))
    )
    path = new_path(spark, "telemetry")
    inputs = rows.filter("d <> 9").select(F.explode(lines).alias("value"))
    outputs = rows.filter("d <> 8").select(src.output_envelope(cid).alias("value"))
    for name, text in (("inputs", inputs), ("outputs", outputs)):
        # Envelopes take some ten times their columns' space; a compressed file is read by one task, so files are many.
        with freeing(spark):
            text.write.option("maxRecordsPerFile", FILE_LINES).text(f"{path}/{name}", compression="gzip")
    return path


def records(spark: SparkSession, sf: str) -> DataFrame:
    return src.scan_envelopes(spark, _write_defective(spark, sf))


TEL = FEAT + f", t as materialized (select *, {ROW_NUMBER} % 97 as d, cast({points('rule_a')} as double) / 1000 as score from f)"
# The counts below follow from the defects, without reading any JSON.
_INPUTS = "count(*) filter (d <> 9) + count(*) filter (d = 3)"
_OUTPUTS = "count(*) filter (d <> 8)"


@query("telemetry_scan", TEL + f"""
select 'inputs' as collection, true as has_id, true as has_row, {_INPUTS} - count(*) filter (d in (1, 2, 12, 4, 5)) as n from t
union all select 'inputs', false, true, count(*) filter (d in (1, 2, 12)) from t
union all select 'inputs', true, false, count(*) filter (d in (4, 5)) from t
union all select 'outputs', true, true, {_OUTPUTS} from t""")
def telemetry_scan(spark, sf):
    found = records(spark, sf)
    return found.groupBy(
        "collection", F.col("correlationid").isNotNull().alias("has_id"), F.col("row").isNotNull().alias("has_row")
    ).agg(F.count(F.lit(1)).alias("n"))


AUDIT = TEL + f""", audit as materialized (
select 'inputs' as collection, {_INPUTS} as records, {_INPUTS} - count(*) filter (d in (1, 2, 12)) as valid_ids,
       count(*) filter (d in (1, 2, 12)) as missing_ids, count(*) filter (d in (4, 5)) as invalid_shapes,
       count(*) filter (d in (6, 7)) as schema_mismatches, count(*) filter (d = 3) as duplicate_ids from t
union all select 'outputs', {_OUTPUTS}, {_OUTPUTS}, 0, 0, 0, 0 from t),
pairing as materialized (select count(*) filter (d not in (1, 2, 8, 9, 12)) as matched, count(*) filter (d = 8) as input_only,
       count(*) filter (d in (1, 2, 9, 12)) as output_only from t)
"""


@query("telemetry_audit", AUDIT + "select * from audit")
def telemetry_audit(spark, sf):
    return tm.audit(records(spark, sf))


@query("telemetry_pairing_audit", AUDIT + "select * from pairing")
def telemetry_pairing_audit(spark, sf):
    return tm.pairing_audit(records(spark, sf))


_CHECKS = {
    "input_records_present": "i.records > 0", "output_records_present": "o.records > 0",
    "input_output_record_counts_match": "i.records = o.records", "input_correlation_ids_unique": "i.duplicate_ids = 0",
    "output_correlation_ids_unique": "o.duplicate_ids = 0", "all_inputs_have_correlation_id": "i.missing_ids = 0",
    "all_outputs_have_correlation_id": "o.missing_ids = 0",
    "input_schema_valid": "i.invalid_shapes = 0 and i.schema_mismatches = 0",
    "output_schema_valid": "o.invalid_shapes = 0 and o.schema_mismatches = 0",
    "all_input_output_pairs_matched": "input_only = 0 and output_only = 0",
}


@query("telemetry_checks", AUDIT + "select " + ", ".join(f"{e} as {n}" for n, e in _CHECKS.items())
       + ", concat_ws(',', " + ", ".join(f"case when not ({e}) then '{n}' end" for n, e in _CHECKS.items())
       + ") as failed, case when " + " and ".join(f"({e})" for e in _CHECKS.values())
       + " then 'PASS' else 'FAIL' end as status from audit i, audit o, pairing where i.collection = 'inputs' and o.collection = 'outputs'")
def telemetry_checks(spark, sf):
    return tm.acceptance_checks(records(spark, sf)).withColumn("failed", F.array_join("failed", ","))


@query("telemetry_pairs", TEL + f"""
select md5(concat('request-', cast(row_id as string))) as correlationid, payment_format, round(amount_paid, 6) as amount_paid,
       sender_previous_tx_count + case when d = 3 then 1000 else 0 end as sender_previous_tx_count, is_business_hours,
       case when d <> 7 then same_account end as same_account, round(score, 6) as score, score >= {THRESHOLD} as alert,
       {THRESHOLD}e0 as threshold, '0.1.0' as model_version
from t where d not in (1, 2, 4, 5, 8, 9, 12)""")
def telemetry_pairs(spark, sf):
    return tm.typed_pairs(tm.pair(records(spark, sf), strict=False))


@query("telemetry_emit", EVF + f"""
select payment_format, count(*) as n, cast(sum(sender_previous_tx_count) as bigint) as prior, count(*) filter (score >= {THRESHOLD}) as alerts
from ef group by 1""")
def telemetry_emit(spark, sf):
    """Emit the scored events, read them back and pair them strictly."""
    path = new_path(spark, "emitted")
    src.emit(md.with_contract(prepared(spark, sf, "event_features"), rule_score("rule_a"), THRESHOLD), path)
    pairs = tm.typed_pairs(tm.pair(src.scan_envelopes(spark, path)))
    return pairs.groupBy("payment_format").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sender_previous_tx_count").alias("prior"), F.count_if("alert").alias("alerts")
    )


def requests(events: DataFrame) -> DataFrame:
    """Events as scoring requests: time, status class and latency."""
    status = F.when(F.col("payment_format") == "error", F.lit("5xx")).otherwise(F.lit("2xx"))
    return events.select("ts", status.alias("status_class"), F.col("amount_paid").alias("latency_ms"))


REQ = EV + """, rq as materialized (select ts, date_trunc('minute', ts) as minute, case when payment_format = 'error' then '5xx' else '2xx' end as status_class,
       amount_paid as latency_ms from ev)"""


@query("telemetry_per_minute", REQ + """
select minute, status_class, count(*) as requests, round(avg(latency_ms), 6) as latency_mean, round(quantile_cont(latency_ms, 0.5), 6) as latency_p50,
       round(quantile_cont(latency_ms, 0.95), 6) as latency_p95, round(quantile_cont(latency_ms, 0.99), 6) as latency_p99 from rq group by 1, 2""")
def telemetry_per_minute(spark, sf):
    return tm.per_minute(requests(prepared(spark, sf, "events")))


@query("traffic_distribution", EVF + """, m as (select 'score' as measure, score as value from ef union all select 'latency_ms', amount_paid from ef)
select measure, count(*) as n, round(avg(value), 6) as mean, min(value) as min, round(quantile_cont(value, 0.05), 6) as p05, round(quantile_cont(value, 0.25), 6) as p25,
       round(quantile_cont(value, 0.5), 6) as median, round(quantile_cont(value, 0.75), 6) as p75, round(quantile_cont(value, 0.95), 6) as p95, max(value) as max
from m group by 1""")
def traffic_distribution(spark, sf):
    """Score and latency of all requests, both from the same passes."""
    rows = prepared(spark, sf, "event_features").withColumn("latency_ms", F.col("amount_paid"))
    melted = rows.unpivot(["row_id"], ["score", "latency_ms"], "measure", "value")
    return dr.score_summary(melted, ["measure"], "value")


# --- drift ------------------------------------------------------------------------

TYPES = {**dr.FEATURE_TYPES, "score": "prediction"}
NUMERIC = [f for f, t in TYPES.items() if t in ("numeric", "prediction")]
CLASSES = [f for f, t in TYPES.items() if t not in ("numeric", "prediction")]

POP = EVF + f""",
ref as materialized (select * from ef where ts < timestamp '{DRIFT_CUT}'),
rest as materialized (select * from ef where ts >= timestamp '{DRIFT_CUT}'),
high as materialized (select * replace (3 * amount_paid as amount_paid) from rest
        where payment_format <> 'click' or substr(md5(concat('d', cast(row_id as string))), 1, 1) = '0'),
rn as materialized (""" + " union all ".join(f"select '{f}' as feature, cast({f} as double) as x from ref" for f in NUMERIC) + """),
q as materialized (select feature, quantile_cont(x, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) as qs from rn group by 1),
u as materialized (select distinct feature, unnest(qs) as e from q),
un as materialized (select feature, e, row_number() over (partition by feature order by e) as i, count(*) over (partition by feature) as m from u),
inn as materialized (select feature, e from un where m = 1 or (i > 1 and i < m))
"""


def _psi_sql(current: str, keys: str = "") -> str:
    """PSI of every feature; ``keys`` is a leading column of the current population."""
    k = f"{keys}, " if keys else ""
    rows = " union all ".join(
        [f"select {{k}}'{f}' as feature, '{t}' as type, cast({f} as string) as text, cast(null as double) as x from {{s}}"
         if f in CLASSES else f"select {{k}}'{f}', '{t}', null, cast({f} as double) from {{s}}"
         for f, t in sorted(TYPES.items(), key=lambda x: x[0] in NUMERIC)])
    bucket = "case when text is not null then text else cast((select count(*) from inn where inn.feature = z.feature and inn.e <= z.x) as string) end"
    on = f"c.{keys} = g.{keys} and " if keys else ""
    g = f"g.{keys}, " if keys else ""
    return f""",
cm as materialized (select {k}feature, type, {bucket} as bucket, count(*) as n from ({rows.format(k=k, s=current)}) z group by all),
rm as materialized (select feature, type, {bucket} as bucket, count(*) as n from ({rows.format(k='', s='ref')}) z group by all),
bins as materialized (select feature, type, bucket from rm union
      select feature, case when feature = 'score' then 'prediction' else 'numeric' end, cast(unnest(range((select count(*) from inn where inn.feature = q.feature) + 1)) as string) from q),
grid as materialized (select distinct {k}feature, type, bucket from cm union select w.{k or ''}b.feature, b.type, b.bucket from bins b, (select distinct {k}1 as one from cm) w),
cnt as materialized (select {g}g.feature, g.type, g.bucket, coalesce(r.n, 0) + 1e-6 as a, coalesce(c.n, 0) + 1e-6 as b from grid g
      left join rm r on r.feature = g.feature and r.bucket = g.bucket left join cm c on {on}c.feature = g.feature and c.bucket = g.bucket),
pr as materialized (select *, a / sum(a) over (partition by {k}feature) as r, b / sum(b) over (partition by {k}feature) as c from cnt),
psi as materialized (select {k}feature, type, sum((c - r) * ln(c / r)) as psi, count(*) as bucket_count from pr group by all),
report as materialized (select *, case when psi < 0.1 then 'low' when psi < 0.25 then 'moderate' else 'significant' end as signal from psi)
""".replace("w.b.feature", "b.feature")


REPORT = POP + _psi_sql("high")
LOW_REPORT = POP + _psi_sql("rest")
_REPORT_COLUMNS = "select feature, type, round(psi, 6) as psi, signal, bucket_count from report"


_PROFILES: dict[tuple, str] = {}


def profile(spark, sf, types=None) -> dr.Profile:
    """The reference's profile, built and saved once per application and loaded by every monitoring query."""
    types = types or TYPES
    key = (spark.sparkContext.applicationId, str(sf), *types.items())
    if key not in _PROFILES:
        path = new_path(spark, "profile")
        dr.save_profile(dr.reference_profile(drift_reference(spark, sf), types), path)
        _PROFILES[key] = path
    return dr.load_profile(spark, _PROFILES[key])


@query("psi_edges", POP + """
select feature, row_number() over (partition by feature order by e) as place, round(e, 6) as edge from inn""")
def psi_edges(spark, sf):
    edges = profile(spark, sf).edges
    return edges.select("feature", F.posexplode("inner").alias("p", "edge")).select(
        "feature", (F.col("p") + 1).cast("long").alias("place"), "edge"
    )


@query("psi_categorical", REPORT + f"select * from ({_REPORT_COLUMNS}) z where type in ('categorical', 'binary')")
def psi_categorical(spark, sf):
    types = {f: TYPES[f] for f in CLASSES}
    reference = drift_reference(spark, sf)
    return dr.drift_report(dr.reference_profile(reference, types), drift_current(spark, sf))


@query("psi_numeric", REPORT + f"select * from ({_REPORT_COLUMNS}) z where type in ('numeric', 'prediction')")
def psi_numeric(spark, sf):
    types = {f: TYPES[f] for f in NUMERIC}
    reference = drift_reference(spark, sf)
    return dr.drift_report(dr.reference_profile(reference, types), drift_current(spark, sf))


@query("drift_report", REPORT + _REPORT_COLUMNS)
def drift_report(spark, sf):
    return dr.drift_report(profile(spark, sf), drift_current(spark, sf))


@query("drift_report_low", LOW_REPORT + _REPORT_COLUMNS)
def drift_report_low(spark, sf):
    return dr.drift_report(profile(spark, sf), drift_current(spark, sf, "low"))


@query("drift_summary", REPORT + """
select case max(case signal when 'significant' then 2 when 'moderate' then 1 else 0 end) when 2 then 'significant' when 1 then 'moderate' else 'low' end as overall_signal,
       coalesce(string_agg(feature, ',' order by feature) filter (signal = 'significant' and type <> 'prediction'), '') as significant_features,
       coalesce(string_agg(feature, ',' order by feature) filter (signal = 'moderate' and type <> 'prediction'), '') as moderate_features,
       max(signal) filter (type = 'prediction') as prediction_signal from report""")
def drift_summary(spark, sf):
    summary = dr.drift_summary(dr.drift_report(profile(spark, sf), drift_current(spark, sf)))
    return summary.withColumns({c: F.array_join(c, ",") for c in ("significant_features", "moderate_features")})


@query("prediction_drift", REPORT + """,
s as (select 'reference' as side, score from ref union all select 'current', score from high)
select side, count(*) as n, round(avg(score), 6) as mean, min(score) as min, round(quantile_cont(score, 0.05), 6) as p05, round(quantile_cont(score, 0.25), 6) as p25,
       round(quantile_cont(score, 0.5), 6) as median, round(quantile_cont(score, 0.75), 6) as p75, round(quantile_cont(score, 0.95), 6) as p95, max(score) as max,
       (select round(psi, 6) from report where feature = 'score') as psi, (select signal from report where feature = 'score') as signal from s group by 1""")
def prediction_drift(spark, sf):
    reference, current = drift_reference(spark, sf), drift_current(spark, sf)
    found = dr.drift_report(dr.reference_profile(reference, {"score": "prediction"}), current)
    sides = reference.select(F.lit("reference").alias("side"), "score").unionByName(
        current.select(F.lit("current").alias("side"), "score")
    )
    value = found.select("psi", "signal").first()
    return dr.score_summary(sides, ["side"]).withColumns({"psi": F.lit(value.psi), "signal": F.lit(value.signal)})


@query("alert_rate_shift", POP + f""", r as (select avg(case when score >= {THRESHOLD} then 1.0e0 else 0 end) as a from ref),
c as (select avg(case when score >= {THRESHOLD} then 1.0e0 else 0 end) as b from high)
select round(a, 6) as reference_alert_rate, round(b, 6) as current_alert_rate, round(100.0e0 * (b - a), 6) as change_pp from r, c""")
def alert_rate_shift(spark, sf):
    return dr.alert_rate_shift(drift_reference(spark, sf), drift_current(spark, sf), THRESHOLD)


# --- policies ---------------------------------------------------------------------

WINDOWS = POP + f""", win as materialized (
select * replace (case when ts >= timestamp '{SHIFT_FROM}' and ts < timestamp '{SHIFT_TO}' then 3 * amount_paid else amount_paid end as amount_paid),
       date_trunc('day', ts) as window_start from rest where date_trunc('day', ts) <> timestamp '{MISSING_DAY}' and row_id % 50 <> 0)""" + _psi_sql("win", "window_start") + f""",
rate as (select window_start, abs(100.0e0 * (avg(case when score >= {THRESHOLD} then 1.0e0 else 0 end)
       - (select avg(case when score >= {THRESHOLD} then 1.0e0 else 0 end) from ref))) >= 1.0e0 as alert_shift from win group by 1),
health as (select date_trunc('day', ts) as window_start, avg(case when payment_format = 'error' then 1.0e0 else 0 end) >= 0.21e0 as unhealthy from ev group by 1),
cond as materialized (select window_start, bool_or(feature = 'score' and psi >= 0.25) as prediction_drift, bool_or(feature <> 'score' and psi >= 0.25) as input_drift,
       count(*) filter (feature <> 'score' and signal = 'moderate') >= 2 as several_moderate from report group by 1),
c2 as materialized (select c.*, alert_shift, coalesce(unhealthy, false) as unhealthy,
       prediction_drift or input_drift or several_moderate or alert_shift or coalesce(unhealthy, false) as condition
       from cond c join rate using (window_start) left join health using (window_start)),
persisted as materialized (select a.*, case when not a.condition then 0 else
       (select count(*) from c2 b where b.window_start <= a.window_start and not exists (
          select 1 from generate_series(b.window_start, a.window_start, interval 1 day) g(d)
          where not exists (select 1 from c2 k where k.window_start = g.d and k.condition))) end as streak from c2 a)
"""


def _persisted(spark, sf) -> DataFrame:
    reference = alert_rate_shift(spark, sf).first().reference_alert_rate
    health = policy.operational_health(requests(prepared(spark, sf, "events")), F.date_trunc("day", "ts"), 0.21)
    return policy.persistence(policy.window_conditions(
        profile(spark, sf), drift_current(spark, sf, "windows"), threshold=THRESHOLD, reference_alert_rate=reference,
        operations=health, controlled=F.col("row_id") % 50 == 0,
    ))


@query("drift_windows", WINDOWS + "select window_start, feature, type, round(psi, 6) as psi, signal, bucket_count from report")
def drift_windows(spark, sf):
    return dr.drift_report(profile(spark, sf), drift_current(spark, sf, "windows").filter("row_id % 50 != 0"), ["window_start"])


@query("drift_persistence", WINDOWS + """
select window_start, prediction_drift, input_drift, several_moderate, alert_shift, unhealthy, condition, streak, streak >= 3 as investigate from persisted""")
def drift_persistence(spark, sf):
    return _persisted(spark, sf)


MIN_LABELS = 100


def _after(prefix: str) -> str:
    """The CTEs of a prefix, to follow another prefix."""
    return ", " + prefix.strip()[len("with "):]


@query("retrain_decision", WINDOWS + _after(REGRESSION) + f"""
select *, drift_sustained and labels_ok and (degraded or population_changed) as retrain_eligible, quality_ok and regression_ok as promote
from (select e.model, (select coalesce(bool_or(streak >= 3), false) from persisted) as drift_sustained,
       (select coalesce(bool_or(streak >= 3 and input_drift), false) from persisted) as population_changed,
       (select coalesce(bool_or(relative < -tolerance and metric in ('average_precision', 'precision', 'recall', 'f1_score')), false)
        from gate where gate.model = e.model) as degraded,
       (select count(*) from scored s where s.model = e.model and s.label = 1) >= {MIN_LABELS} as labels_ok,
       average_precision >= 0.035e0 and recall >= 0.65e0 as quality_ok,
       (select count(*) filter (status = 'regressed') = 0 from gate where gate.model = e.model) as regression_ok from evl e) d""")
def retrain_decision(spark, sf):
    rows = scored(spark, sf)
    metrics = stage(rk.evaluation(rows), "evaluation")
    long = gates.metrics_long(metrics)
    verdict = gates.regression_rows(long, long.filter("model = 'rule_a'"))
    labels = rows.filter("label = 1").groupBy("model").agg(F.count(F.lit(1)).alias("n_labels"))
    return policy.retrain_decision(_persisted(spark, sf), gates.quality_gate(metrics), verdict, labels, MIN_LABELS)


# --- streaming --------------------------------------------------------------------

SLICE_DAYS = 3
#: Rows of the whole input for one file a slice.
ROWS_A_FILE = 1_000_000


def arrivals(spark: SparkSession, df: DataFrame, label: str) -> tuple[str, int]:
    """Write rows as files in arrival order: one append per few days of event time.

    Returns the folder and the files a slice. Triggers take a number of slices, so micro-batches grow with
    the input and not their number.
    """
    path = new_path(spark, label)
    first, last, rows = df.agg(F.min("ts"), F.max("ts"), F.count(F.lit(1))).first()
    files = 1 + rows // ROWS_A_FILE
    start = datetime(first.year, first.month, first.day)
    while start <= last:
        end = start + timedelta(days=SLICE_DAYS)
        part = df.filter((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(end)))
        part.repartition(files, "row_id").write.mode("append").parquet(path)
        start = end
    return path, files


@query("stream_per_minute", REQ + """
select minute, status_class, count(*) as requests, round(avg(latency_ms), 6) as latency_mean,
       round(quantile_disc(latency_ms, 0.5), 6) as latency_p50, round(quantile_disc(latency_ms, 0.95), 6) as latency_p95,
       round(quantile_disc(latency_ms, 0.99), 6) as latency_p99 from rq
where minute + interval 1 minute <= (select max(ts) from rq) - interval 10 minute group by 1, 2""")
def stream_per_minute(spark, sf):
    """Windows the watermark has closed; the last minutes stay open."""
    events = requests(prepared(spark, sf, "events")).withColumn("row_id", F.monotonically_increasing_id())
    (path, files), out = arrivals(spark, events, "requests"), new_path(spark, "minutes")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2 * files).parquet(path)
    per_minute = jobs.per_minute_stream(stream, delay="10 minutes")
    sink = per_minute.writeStream.format("parquet").option("path", out)
    sink.option("checkpointLocation", new_path(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(per_minute.schema).parquet(out)


@query("stream_prev_count", EVF + "select row_id, account, sender_previous_tx_count from ef")
def stream_prev_count(spark, sf):
    """The prior count over a stream of all events, closed by a final flush."""
    events = prepared(spark, sf, "events")
    path, files = arrivals(spark, events, "payments")
    state = jobs.PriorCountState(spark, new_path(spark, "prior-count"), compact_every=4)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 3 * files).parquet(path)
    run = jobs.prior_count_stream(stream, state, new_path(spark, "checkpoint"), delay="7 days")
    run.awaitTermination()
    batches = run.lastProgress["batchId"] + 1 if run.lastProgress else 0
    jobs.close_prior_count(state, events.limit(0), batches)
    return jobs.counted(state).select("row_id", "account", "sender_previous_tx_count")


@query("stream_score", EVF + f"""
select cast(ts as date) as event_date, hour as event_hour, count(*) as n, count(*) filter (score >= {THRESHOLD}) as alerts from ef group by 1, 2""")
def stream_score(spark, sf):
    """Score all events as a stream and count the paired records by event hour."""
    rows = prepared(spark, sf, "event_features")
    (path, files), out = arrivals(spark, rows, "features"), new_path(spark, "collected")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 10 * files).parquet(path)
    run = jobs.score_stream(
        stream, lambda batch: md.with_contract(batch, rule_score("rule_a"), THRESHOLD), out, new_path(spark, "checkpoint")
    )
    run.awaitTermination()
    return jobs.collected_by_hour(spark, out)
