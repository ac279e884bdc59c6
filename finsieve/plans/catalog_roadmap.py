"""Queries: rolling behaviour, payment graph, other splits, calibration, thresholds chosen on a fold of their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from finsieve.constants import PRECISION_TARGETS
from finsieve.operators import calibration as ca, ranking as rk, rolling as ro, smote
from finsieve.plans.catalog_ranking import train_fold
from finsieve.plans.registry import FEAT, SCORED, TX, query
from finsieve.plans.views import ledger, scored

_SPANS = {"1h": "1 hour", "24h": "24 hour", "7d": "168 hour"}


@query("roll_velocity", TX + " select row_id, " + ", ".join(
    f"count(*) over w{n} as n_{n}, round(coalesce(sum(amount_paid) over w{n}, 0), 4) as sum_{n}" for n in _SPANS) + " from tx window " + ", ".join(
    f"w{n} as (partition by account order by ts range between interval {i} preceding and interval 1 microsecond preceding)"
    for n, i in _SPANS.items()), digits=4)
def roll_velocity(spark, sf):
    rows = ro.rolling_velocity(ledger(spark, sf).select("row_id", "account", "ts", "amount_paid"))
    return rows.select("row_id", *[c for n in _SPANS for c in (f"n_{n}", f"sum_{n}")])


@query("roll_diversity", TX + """
select row_id, cast((select count(distinct b.counterparty) from tx b where b.account = a.account and b.ts < a.ts and b.ts >= a.ts - interval 168 hour) as integer)
       as n_counterparties from tx a""")
def roll_diversity(spark, sf):
    rows = ledger(spark, sf).select("row_id", "account", "ts", "counterparty")
    return ro.rolling_diversity(rows).select("row_id", "n_counterparties")


@query("amount_zscore", TX + """, w as (select row_id, amount_paid, count(*) over p as n, avg(amount_paid) over p as m, stddev_samp(amount_paid) over p as s
from tx window p as (partition by account order by ts range between unbounded preceding and interval 1 microsecond preceding))
select row_id, case when abs(z) < 1000 then round(z, 3) + 0.0e0 else round(z / pow(10, floor(log10(abs(z))) - 2)) * pow(10, floor(log10(abs(z))) - 2) end as amount_z
from (select row_id, case when n >= 2 then (amount_paid - m) / nullif(s, 0) end as z from w)""", digits=3)
def amount_zscore(spark, sf):
    rows = ledger(spark, sf).select("row_id", "account", "ts", "amount_paid")
    z, unit = F.col("amount_z"), F.pow(F.lit(10.0), F.floor(F.log10(F.abs("amount_z"))) - 2)
    # Three decimals, and three digits of what is larger, as engines add in another order.
    return ro.amount_zscore(rows).select(
        "row_id", F.when(F.abs(z) < 1000, F.round(z, 3) + 0.0).otherwise(F.round(z / unit, 0) * unit).alias("amount_z"))


@query("fan_in_out", TX + """, o as (select account, count(distinct counterparty) as fan_out, count(*) as n_out from tx group by 1),
i as (select counterparty as account, count(distinct account) as fan_in, count(*) as n_in from tx group by 1)
select coalesce(o.account, i.account) as account, coalesce(fan_out, 0) as fan_out, coalesce(n_out, 0) as n_out, coalesce(fan_in, 0) as fan_in,
       coalesce(n_in, 0) as n_in from o full join i on o.account = i.account""")
def fan_in_out(spark, sf):
    return ro.fan_in_out(ledger(spark, sf))


@query("reciprocal_pairs", TX + """, e as (select account as s, counterparty as t, count(*) as n from tx where account <> counterparty group by 1, 2)
select x.s as a, x.t as b, x.n as n_ab, y.n as n_ba from e x join e y on x.s = y.t and x.t = y.s where x.s < x.t""")
def reciprocal_pairs(spark, sf):
    return ro.reciprocal_pairs(ledger(spark, sf))


@query("split_temporal", TX + """, c as (select quantile_cont(epoch_us(ts), 0.7) as cut from tx)
select split, count(*) as n, min(ts) as first_ts, max(ts) as last_ts, cast(sum(is_laundering) as bigint) as n_positive
from (select *, case when epoch_us(ts) > (select cut from c) then 'test' else 'train' end as split from tx) group by 1""")
def split_temporal(spark, sf):
    return ro.split_temporal(ledger(spark, sf)).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.sum(F.col("is_laundering").cast("long")).alias("n_positive"),
    )


@query("split_entity", TX + """
select row_id, account, case when substr(md5(concat('42-', account)), 1, 4) < '4ccd' then 'test' else 'train' end as split from tx""")
def split_entity(spark, sf):
    return ro.split_entity(ledger(spark, sf)).select("row_id", "account", "split")


@query("calibration_bins", SCORED + """
select model, cast(least(floor(score * 10), 9) as integer) as bin, count(*) as n, round(avg(score), 6) as mean_score, round(avg(cast(label as double)), 6) as observed_rate,
       round(avg((score - label) * (score - label)), 6) as brier, round(avg(score) - avg(cast(label as double)), 6) + 0.0e0 as gap from scored group by 1, 2""")
def calibration_bins(spark, sf):
    return ro.calibration_bins(scored(spark, sf)).withColumn("gap", F.round("gap", 6) + 0.0)


_FOLD = "case when h < '5555' then 'valid' when h < 'aaaa' then 'test' else 'train' end"


@query("threshold_validated", SCORED + f""", s as materialized (select *, {_FOLD} as fold from (
  select *, substr(md5(concat('fold-', row_id)), 1, 4) as h from scored)),
c as (select model, score, sum(count(*)) over w as alerts, sum(sum(label)) over w as tp from s where fold = 'valid' group by model, score
      window w as (partition by model order by score desc)),
p as (select model, coalesce(min(score) filter (tp / alerts >= {PRECISION_TARGETS[3]}), arg_max(score, (tp / alerts, -score))) as threshold from c group by 1),
v as (select model, count(*) as n_valid from s where fold = 'valid' group by 1)
select s.model, threshold, n_valid, count(*) filter (score >= threshold and label = 1) as tp, count(*) filter (score >= threshold and label = 0) as fp,
       count(*) filter (score < threshold and label = 1) as fn, count(*) filter (score < threshold and label = 0) as tn,
       round(count(*) filter (score >= threshold and label = 1) / nullif(count(*) filter (score >= threshold), 0), 6) as precision,
       round(count(*) filter (score >= threshold and label = 1) / nullif(count(*) filter (label = 1), 0), 6) as recall
from s join p using (model) join v using (model) where fold = 'test' group by s.model, threshold, n_valid""")
def threshold_validated(spark, sf):
    fold = F.expr(_FOLD.replace("h <", "substr(md5(concat('fold-', row_id)), 1, 4) <"))
    rows = scored(spark, sf).withColumn("fold", fold)
    valid, test = rows.filter("fold = 'valid'").drop("fold"), rows.filter("fold = 'test'").drop("fold")
    return ro.threshold_validated(valid, test, rk.operating_point(valid, PRECISION_TARGETS[3]))


@query("calibrated", SCORED + f""", s as materialized (select *, {_FOLD} as fold from (
  select *, substr(md5(concat('fold-', row_id)), 1, 4) as h from scored)),
c as materialized (select model, score, sum(count(*)) over w as n, sum(sum(label)) over w as p, row_number() over w as i from s where fold = 'valid' group by model, score
      window w as (partition by model order by score)),
lows as (select a.model, a.i, a.score, min((z.p - coalesce(b.p, 0)) / (z.n - coalesce(b.n, 0))) as low
         from c a join c j on j.model = a.model and j.i <= a.i left join c b on b.model = j.model and b.i = j.i - 1
         join c z on z.model = a.model and z.i >= a.i group by a.model, a.i, a.score, j.i),
fit as materialized (select model, score, max(low) as v from lows group by model, i, score),
q as (select distinct model, score from s where fold = 'test'),
near as (select q.model, q.score, max(f.score) filter (f.score <= q.score) as s0, min(f.score) filter (f.score >= q.score) as s1
         from q join fit f using (model) group by 1, 2),
val as (select n.model, n.score, case when s0 is null then b.v when s1 is null or s0 = s1 then a.v else a.v + (n.score - s0) / (s1 - s0) * (b.v - a.v) end as v
        from near n left join fit a on a.model = n.model and a.score = s0 left join fit b on b.model = n.model and b.score = s1),
t as (select model, v, label from s join val using (model, score) where fold = 'test')
select model, cast(least(floor(round(v, 9) * 50), 49) as integer) as bin, count(*) as n, round(avg(v), 6) as mean_score, round(avg(cast(label as double)), 6) as observed_rate,
       round(avg((v - label) * (v - label)), 6) as brier, round(avg(v) - avg(cast(label as double)), 6) + 0.0e0 as gap from t group by 1, 2""")
def calibrated(spark, sf):
    """Fitted on one fold; the bins are those of another."""
    fold = F.expr(_FOLD.replace("h <", "substr(md5(concat('fold-', row_id)), 1, 4) <"))
    rows = scored(spark, sf).withColumn("fold", fold)
    steps = ca.isotonic(rows.filter("fold = 'valid'"))
    done = ca.calibrate(rows.filter("fold = 'test'").drop("fold"), steps)
    return ro.calibration_bins(done.withColumn("score", F.round("score", 9)), bins=50).withColumn("gap", F.round("gap", 6) + 0.0)


@query("smotenc_neighbours", FEAT + """, m as materialized (select row_id, amount_paid as a, cast(sender_previous_tx_count as double) as b, payment_format as f,
  is_business_hours as g, same_account as h from f where split = 'train' and is_laundering = 1),
p as (select pow((stddev_samp(a) + stddev_samp(b)) / 2, 2) as q from m),
d as (select x.row_id, y.row_id as neighbour, (x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b) + (select q from p) * (
      cast(x.f <> y.f as integer) + cast(x.g <> y.g as integer) + cast(x.h <> y.h as integer)) as distance2 from m x join m y on x.row_id <> y.row_id),
r as (select *, row_number() over (partition by row_id order by distance2, neighbour) as rank from d)
select row_id, cast(rank as integer) as rank, round(sqrt(distance2), 3) as distance from r where rank <= 5""", digits=3)
def smotenc_neighbours(spark, sf):
    """Distances of the five nearest rows of each illicit training row; which row it is may hang on the last bit of a tie."""
    rows = train_fold(spark, sf).filter("is_laundering = 1")
    return smote.neighbours(rows).select("row_id", "rank", F.sqrt("distance2").alias("distance"))


@query("smotenc")
def smotenc(spark, sf):
    """As many synthetic illicit rows as balance the training fold."""
    rows = train_fold(spark, sf)
    sizes = {r[0]: r[1] for r in rows.groupBy("is_laundering").count().collect()}
    return smote.smotenc(rows, sizes.get(0, 0) - sizes.get(1, 0))
