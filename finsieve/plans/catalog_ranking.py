"""Queries: preparation, models, ranking evaluation, gates and attribution."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from finsieve.constants import (
    ALERT_BUDGETS, ATTRIBUTION_SAMPLE_ROWS, NUMERIC_FEATURES, PRECISION_TARGETS, SCORE_PARITY_TOLERANCE,
)
from finsieve.operators import attribution as at, gates, models as md, prep, ranking as rk
from finsieve.operators.telemetry import traffic_by_format
from finsieve.operators.tree_attribution import tree_attribution
from finsieve.plans.registry import FEAT, SCORED, THRESHOLD, points, query
from finsieve.plans.views import MODELS, features, ledger, rule_score, rule_terms, scored
from finsieve.session import new_path, stage

def split(spark, sf) -> DataFrame:
    return prep.split_by_hash(features(spark, sf))


def train_fold(spark, sf) -> DataFrame:
    return split(spark, sf).filter("split = 'train'")


def test_fold(spark, sf) -> DataFrame:
    return split(spark, sf).filter("split = 'test'")


# --- preparation ------------------------------------------------------------------


@query("split_hash", FEAT + "select row_id, is_laundering, split from f")
def split_hash(spark, sf):
    return split(spark, sf).select("row_id", "is_laundering", "split")


@query("split_exact", FEAT + """,
c as (select is_laundering, count(*) as n from f group by 1),
q as (select is_laundering, n, ceil(0.3e0 * sum(n) over ()) as n_test, ceil(0.3e0 * sum(n) over ()) * n / sum(n) over () as quota from c),
o as (select *, n_test - sum(floor(quota)) over () as spare,
             row_number() over (order by floor(quota) - quota, is_laundering) as turn from q),
k as (select is_laundering, floor(quota) + case when turn <= spare then 1 else 0 end as take from o),
r as (select row_id, is_laundering, row_number() over (partition by is_laundering order by md5(concat('42-', cast(row_id as string))), row_id) as place from f)
select row_id, is_laundering, case when place <= take then 'test' else 'train' end as split from r join k using (is_laundering)""")
def split_exact(spark, sf):
    return prep.split_exact(ledger(spark, sf).select("row_id", "is_laundering"))


@query("split_manifest", FEAT + "select split, count(*) as n, cast(sum(is_laundering) as bigint) as n_positive from f group by 1")
def split_manifest(spark, sf):
    return prep.split_manifest(split(spark, sf))


@query("class_weights", FEAT + """, c as (select count(*) as n, cast(sum(is_laundering) as bigint) as n_pos from f where split = 'train')
select n, n_pos, n - n_pos as n_neg, round((n - n_pos) / n_pos, 6) as scale_pos_weight,
       round(n / (2 * (n - n_pos)), 6) as balanced_neg, round(n / (2 * n_pos), 6) as balanced_pos from c""")
def class_weights(spark, sf):
    return prep.class_weights(train_fold(spark, sf))


@query("undersample", FEAT + """, t as (select * from f where split = 'train'),
r as (select row_id, is_laundering, row_number() over (order by md5(concat('42-', cast(row_id as string))), row_id) as place from t where is_laundering = 0)
select row_id, is_laundering from t where is_laundering = 1
union all select row_id, is_laundering from r where place <= (select floor(sum(is_laundering) / 0.1e0) from t)""")
def undersample(spark, sf):
    return prep.undersample(train_fold(spark, sf).select("row_id", "is_laundering"))


@query("seeded_sample", FEAT + """
select row_id, is_laundering from f order by md5(concat('42-', cast(row_id as string))), row_id limit 5000""")
def seeded_sample(spark, sf):
    return prep.seeded_sample(ledger(spark, sf).select("row_id", "is_laundering"), ATTRIBUTION_SAMPLE_ROWS)


@query("onehot_unknown", FEAT + """
select payment_format, count(*) as n, count(*) filter (payment_format <> '5-LOW') * 1.0e0 as n_active from f group by 1""")
def onehot_unknown(spark, sf):
    """A format held out of the fit encodes to all zeros."""
    rows = features(spark, sf).select("payment_format")
    encoder = Pipeline(stages=[
        StringIndexer(inputCol="payment_format", outputCol="ix", handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol="ix", outputCol="oh", dropLast=True),
    ]).fit(rows.filter("payment_format <> '5-LOW'"))
    active = F.aggregate(vector_to_array("oh"), F.lit(0.0), lambda a, x: a + x)
    return encoder.transform(rows).groupBy("payment_format").agg(F.count(F.lit(1)).alias("n"), F.sum(active).alias("n_active"))


@query("scaled_numeric", FEAT + """,
w as (select row_id, amount_paid, sender_previous_tx_count, avg(amount_paid) filter (split = 'train') over () as m1,
             stddev_samp(amount_paid) filter (split = 'train') over () as s1, avg(sender_previous_tx_count) filter (split = 'train') over () as m2,
             stddev_samp(sender_previous_tx_count) filter (split = 'train') over () as s2 from f)
select row_id, round((amount_paid - m1) / s1, 5) + 0.0e0 as amount_paid_scaled,
       round((sender_previous_tx_count - m2) / s2, 5) + 0.0e0 as prior_count_scaled from w""", digits=5)
def scaled_numeric(spark, sf):
    scaler = Pipeline(stages=[
        VectorAssembler(inputCols=list(NUMERIC_FEATURES), outputCol="numeric"),
        StandardScaler(inputCol="numeric", outputCol="scaled", withMean=True, withStd=True),
    ]).fit(train_fold(spark, sf))
    values = vector_to_array("scaled")
    return scaler.transform(features(spark, sf)).select(
        "row_id", values[0].alias("amount_paid_scaled"), values[1].alias("prior_count_scaled")
    )


# --- ranking evaluation -----------------------------------------------------------

CURVE = SCORED + """,
s1 as (select model, score, count(*) as n, cast(sum(label) as bigint) as tp from {source} group by 1, 2),
curve as materialized (select model, score, n, tp, cast(sum(n) over w as bigint) as cum_n, cast(sum(tp) over w as bigint) as cum_tp,
       cast(sum(n) over (partition by model) as bigint) as n_total, cast(sum(tp) over (partition by model) as bigint) as p_total
       from s1 window w as (partition by model order by score desc))
"""
CURVE64 = CURVE.format(source="scored")
CURVE32 = CURVE.format(source="(select model, row_id, label, cast(cast(score as float) as double) as score from scored) z")

_METRIC_SQL = """
  n - p - alerts + tp as tn, alerts - tp as fp, p - tp as fn, tp, round((n - p - alerts + 2 * tp) / n, 6) as accuracy,
  round(case when alerts = 0 then 0 else tp / alerts end, 6) as precision, round(case when p = 0 then 0 else tp / p end, 6) as recall,
  round(case when tp = 0 then 0 else 2 * (tp / alerts) * (tp / p) / (tp / alerts + tp / p) end, 6) as f1_score,
  alerts, round(100.0e0 * alerts / n, 6) as alert_rate_pct"""


@query("confusion_matrix", SCORED + f"""
select model, count(*) filter (score < {THRESHOLD} and label = 0) as tn, count(*) filter (score >= {THRESHOLD} and label = 0) as fp,
       count(*) filter (score < {THRESHOLD} and label = 1) as fn, count(*) filter (score >= {THRESHOLD} and label = 1) as tp
from scored group by 1""")
def confusion_matrix(spark, sf):
    return rk.confusion(scored(spark, sf), THRESHOLD)


_CUT = f"""(select model, count(*) as n, cast(sum(label) as bigint) as p, count(*) filter (score >= {THRESHOLD}) as alerts,
       count(*) filter (score >= {THRESHOLD} and label = 1) as tp from scored group by 1) c"""


@query("threshold_metrics", SCORED + f"select model, {_METRIC_SQL} from {_CUT}")
def threshold_metrics(spark, sf):
    return rk.threshold_metrics(scored(spark, sf), THRESHOLD)


@query("average_precision", CURVE64 + """
select model, round(sum((tp / p_total) * (cum_tp / cum_n)), 6) as average_precision, round(max(cum_tp / cum_n), 6) as max_precision
from curve group by 1""")
def average_precision(spark, sf):
    return rk.average_precision(scored(spark, sf))


@query("pr_curve", CURVE64 + """
select model, round(score, 6) as threshold, round(cum_tp / cum_n, 6) as precision, round(cum_tp / p_total, 6) as recall, cum_n, cum_tp from curve""")
def pr_curve(spark, sf):
    return rk.pr_curve(scored(spark, sf)).select("model", "threshold", "precision", "recall", "cum_n", "cum_tp")


@query("max_precision", CURVE64 + "select model, round(max(cum_tp / cum_n), 6) as max_precision from curve group by 1")
def max_precision(spark, sf):
    return rk.average_precision(scored(spark, sf)).select("model", "max_precision")


def _point_sql(target: float) -> str:
    return f""", hit as (select model, min(score) as t from curve where cum_tp / cum_n >= {target}e0 group by 1),
best as (select model, score as t, row_number() over (partition by model order by cum_tp / cum_n desc, score) as r from curve),
pick as (select b.model, h.t is not null as reached, coalesce(h.t, b.t) as t from best b left join hit h on b.model = h.model where b.r = 1),
point as (select c.model, reached, t, cum_n as alerts, cum_tp as tp, n_total as n, p_total as p from pick join curve c on c.model = pick.model and c.score = pick.t)
"""


@query("operating_point", CURVE64 + _point_sql(0.02) + f"""
select model, 0.02e0 as precision_target, reached, round(t, 6) as threshold, {_METRIC_SQL} from point""")
def operating_point(spark, sf):
    return rk.operating_point(scored(spark, sf))


@query("operating_point_unreached", CURVE64 + _point_sql(0.9) + f"""
select model, 0.9e0 as precision_target, reached, round(t, 6) as threshold, {_METRIC_SQL} from point""")
def operating_point_unreached(spark, sf):
    return rk.operating_point(scored(spark, sf), 0.9)


TARGETS = (*PRECISION_TARGETS, 0.5)

FIXED = CURVE32 + ", targets as (" + " union all ".join(f"select {t}e0 as precision_target" for t in TARGETS) + """),
pick as (select model, precision_target, min(score) as t from curve, targets where cum_tp / cum_n >= precision_target group by 1, 2),
tot as (select model, max(n_total) as nn, max(p_total) as pp from curve group by 1),
fixed as materialized (
  select tot.model, targets.precision_target, round(t, 6) as threshold, round(cum_tp / cum_n, 6) as precision, round(cum_tp / pp, 6) as recall,
         coalesce(cum_n, 0) as alerts, round(100.0e0 * coalesce(cum_n, 0) / nn, 6) as alert_rate_pct,
         coalesce(cum_tp, 0) as tp, coalesce(cum_n - cum_tp, 0) as fp, pp - coalesce(cum_tp, 0) as fn,
         nn - pp - coalesce(cum_n - cum_tp, 0) as tn,
         round(case when cum_tp = 0 then cast('inf' as double) else cum_n / cum_tp end, 6) as alerts_per_tp
  from tot cross join targets left join pick on pick.model = tot.model and pick.precision_target = targets.precision_target
       left join curve on curve.model = pick.model and curve.score = pick.t)
"""


@query("fixed_precision", FIXED + "select * from fixed")
def fixed_precision(spark, sf):
    return rk.fixed_precision(scored(spark, sf), TARGETS).orderBy("precision_target", F.desc("recall"))


@query("best_model_per_precision", FIXED + """
select * exclude (r) from (select *, row_number() over (partition by precision_target order by recall desc, model) as r
from fixed where recall is not null) x where r = 1""")
def best_model_per_precision(spark, sf):
    return rk.best_per(rk.fixed_precision(scored(spark, sf), TARGETS), "precision_target", "recall")


@query("final_operating_point", FIXED + "select * from fixed where model = 'rule_a' and abs(precision_target - 0.02e0) < 1e-9")
def final_operating_point(spark, sf):
    return rk.selected_point(rk.fixed_precision(scored(spark, sf), TARGETS), "rule_a", 0.02)


BUDGET = SCORED + ", budgets as (" + " union all ".join(f"select {b}e0 as budget" for b in ALERT_BUDGETS) + """),
r as materialized (select model, label, cast(cast(score as float) as double) as score,
       row_number() over (partition by model order by cast(score as float) desc, row_id desc) as place from scored),
tot as (select model, count(*) as n, cast(sum(label) as bigint) as p from scored group by 1),
k as (select model, budget, n, p, greatest(1, cast(ceil(n * budget) as bigint)) as alerts from tot, budgets),
hits as (select k.model, budget, n, p, alerts, cast(sum(label) as bigint) as tp, min(score) as boundary from k join r on r.model = k.model and place <= alerts
         group by all),
budget_rows as materialized (
  select model, budget, alerts, round(boundary, 6) as boundary_score, round((n - p - alerts + 2 * tp) / n, 6) as accuracy,
         round(tp / alerts, 6) as precision, round(tp / p, 6) as recall,
         round(case when tp = 0 then 0 else 2 * (tp / alerts) * (tp / p) / (tp / alerts + tp / p) end, 6) as f1_score,
         tp, alerts - tp as fp, p - tp as fn, n - p - alerts + tp as tn,
         round(case when tp = 0 then cast('inf' as double) else alerts / tp end, 6) as alerts_per_tp from hits)
"""


@query("alert_budgets", BUDGET + "select * from budget_rows")
def alert_budgets(spark, sf):
    return rk.alert_budgets(scored(spark, sf)).orderBy("budget", F.desc("recall"))


@query("best_model_per_budget", BUDGET + """
select * exclude (r) from (select *, row_number() over (partition by budget order by recall desc, model) as r from budget_rows) x where r = 1""")
def best_model_per_budget(spark, sf):
    return rk.best_per(rk.alert_budgets(scored(spark, sf)), "budget", "recall")


def _pivot_sql(metric: str) -> str:
    return BUDGET + f"""select budget, max({metric}) filter (model = 'rule_a') as rule_a, max({metric}) filter (model = 'rule_b') as rule_b
from budget_rows group by 1"""


@query("recall_by_budget", _pivot_sql("recall"))
def recall_by_budget(spark, sf):
    return rk.pivot_models(rk.alert_budgets(scored(spark, sf)), "budget", "recall", MODELS)


@query("precision_by_budget", _pivot_sql("precision"))
def precision_by_budget(spark, sf):
    return rk.pivot_models(rk.alert_budgets(scored(spark, sf)), "budget", "precision", MODELS)


@query("top_alert_cases", SCORED + f"""
select model, case when label = 1 then 'true_positive' else 'false_positive' end as "case", row_id, score
from (select *, row_number() over (partition by model, label order by score desc, row_id) as r from scored where score >= {THRESHOLD}) x where r = 1""")
def top_alert_cases(spark, sf):
    return rk.top_cases(scored(spark, sf), THRESHOLD)


@query("classification_report", SCORED + f""",
c as (select model, label, count(*) as support, count(*) filter ((score >= {THRESHOLD}) = (label = 1)) as hit,
             count(*) filter ((score >= {THRESHOLD}) <> (label = 1)) as missed from scored group by 1, 2),
m as (select a.model, cast(a.label as string) as class, a.hit / (a.hit + b.missed) as p, a.hit / a.support as r, a.support
      from c a join c b on a.model = b.model and a.label <> b.label),
g as (select *, case when p + r = 0 then 0 else 2 * p * r / (p + r) end as f from m)
select model, class, round(p, 6) as precision, round(r, 6) as recall, round(f, 6) as f1_score, support from g
union all select model, 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), cast(sum(support) as bigint) from g group by 1
union all select model, 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
                 round(sum(f * support) / sum(support), 6), cast(sum(support) as bigint) from g group by 1""")
def classification_report(spark, sf):
    return rk.classification_report(scored(spark, sf), THRESHOLD)


# --- gates ------------------------------------------------------------------------

EVAL = CURVE64 + _point_sql(0.02) + """,
ap as (select model, sum((tp / p_total) * (cum_tp / cum_n)) as average_precision, max(cum_tp / cum_n) as max_precision from curve group by 1),
evl as materialized (select model, average_precision, max_precision, t as threshold, (n - p - alerts + 2 * tp) / n as accuracy, tp / alerts as precision, tp / p as recall,
       2 * (tp / alerts) * (tp / p) / (tp / alerts + tp / p) as f1_score, cast(alerts as double) as alerts, 100.0e0 * alerts / n as alert_rate_pct,
       cast(tp as double) as tp, cast(alerts - tp as double) as fp, cast(p - tp as double) as fn, cast(n - p - alerts + tp as double) as tn
       from point join ap using (model)),
long as materialized (unpivot evl on columns(* exclude (model)) into name metric value value)
"""
REGRESSION = EVAL + """,
pairs as (select o.model, o.metric, b.value as baseline, o.value as observed, o.value - b.value as delta,
       case when b.value = 0 then 0 else (o.value - b.value) / b.value end as relative,
       case when o.metric in ('average_precision', 'precision', 'recall', 'threshold') then 0.05e0
            when o.metric in ('f1_score', 'alerts', 'alert_rate_pct') then 0.10e0 end as tolerance
       from long o join long b on o.metric = b.metric and b.model = 'rule_a'),
gate as materialized (select *, case when tolerance is null then 'info' when abs(relative) <= tolerance then 'ok' else 'regressed' end as status from pairs)
"""


def _evaluation(spark, sf) -> DataFrame:
    return stage(rk.evaluation(scored(spark, sf)), "evaluation")


def _regression(spark, sf) -> tuple[DataFrame, DataFrame]:
    metrics = _evaluation(spark, sf)
    long = gates.metrics_long(metrics)
    return metrics, gates.regression_rows(long, long.filter("model = 'rule_a'"))


@query("metrics_long", EVAL + "select model, metric, round(value, 6) as value from long")
def metrics_long(spark, sf):
    """Accuracy, F1, alerts and alert rate are dropped first, so the table has to derive them."""
    given = rk.evaluation(scored(spark, sf)).withColumn("n_test", F.expr("tp + fp + fn + tn"))
    return gates.metrics_long(given.drop("accuracy", "f1_score", "alerts", "alert_rate_pct"), "n_test")


@query("quality_gate", EVAL + """
select model, round(average_precision, 6) as average_precision, round(recall, 6) as recall, average_precision >= 0.035e0 as ap_ok,
       recall >= 0.65e0 as recall_ok, average_precision >= 0.035e0 and recall >= 0.65e0 as passed from evl""")
def quality_gate(spark, sf):
    return gates.quality_gate(rk.evaluation(scored(spark, sf)))


@query("regression_gate", REGRESSION + """
select model, metric, round(baseline, 6) as baseline, round(observed, 6) as observed, round(delta, 6) + 0.0e0 as delta,
       round(relative, 6) + 0.0e0 as relative, tolerance, status from gate""")
def regression_gate(spark, sf):
    return _regression(spark, sf)[1]


@query("regression_verdict", REGRESSION + """
select model, coalesce(string_agg(metric, ',' order by metric) filter (status = 'regressed'), '') as failing,
       count(*) filter (status = 'regressed') = 0 as passed from gate group by 1""")
def regression_verdict(spark, sf):
    return gates.regression_verdict(_regression(spark, sf)[1]).withColumn("failing", F.array_join("failing", ","))


# --- models -----------------------------------------------------------------------


_FITTED: dict[tuple[str, str, str], str] = {}


def fitted(spark, sf, name: str, drop: tuple[str, ...] = ()) -> PipelineModel:
    """A model over the train fold, fitted and saved once per application and read back by every query."""
    key = (spark.sparkContext.applicationId, str(sf), " ".join([name, *drop]))
    if key not in _FITTED:
        path = new_path(spark, name)
        md.fit(train_fold(spark, sf), md.specs()[name], drop).write().save(path)
        _FITTED[key] = path
    return PipelineModel.load(_FITTED[key])


def _evaluated(spark, sf, name: str) -> DataFrame:
    return rk.evaluation(md.scored(fitted(spark, sf, name), test_fold(spark, sf), name))


@query("model_dummy_metrics", FEAT + """, c as (select count(*) as n, cast(sum(is_laundering) as bigint) as p from f where split = 'test')
select 'majority' as model, round(p / n, 6) as average_precision, round(p / n, 6) as max_precision, 0.02e0 as precision_target, p / n >= 0.02e0 as reached,
       0.0e0 as threshold, n - p - n + p as tn, n - p as fp, cast(0 as bigint) as fn, p as tp, round(p / n, 6) as accuracy, round(p / n, 6) as precision,
       1.0e0 as recall, round(2 * (p / n) / (p / n + 1), 6) as f1_score, n as alerts, 100.0e0 as alert_rate_pct from c""")
def model_dummy_metrics(spark, sf):
    return rk.evaluation(md.majority_scored(test_fold(spark, sf)))


@query("model_lr_balanced")
def model_lr_balanced(spark, sf):
    return _evaluated(spark, sf, "logistic_balanced")


@query("model_lr_plain")
def model_lr_plain(spark, sf):
    return _evaluated(spark, sf, "logistic_plain")


@query("model_rf")
def model_rf(spark, sf):
    return _evaluated(spark, sf, "random_forest")


@query("model_gbt")
def model_gbt(spark, sf):
    return _evaluated(spark, sf, "boosted_weighted")


@query("model_gbt_under")
def model_gbt_under(spark, sf):
    return _evaluated(spark, sf, "boosted_undersampled")


@query("model_comparison")
def model_comparison(spark, sf):
    """Every model on the same test fold at threshold 0.5, by average precision."""
    test = test_fold(spark, sf)
    train_fold(spark, sf)  # the views are there before the fits share them
    # A fit waits most of its time for some thousand small jobs, so fits run side by side.
    with ThreadPoolExecutor(len(md.specs())) as pool:
        models = dict(zip(md.specs(), pool.map(inheritable_thread_target(lambda name: fitted(spark, sf, name)), md.specs())))
    parts = [md.majority_scored(test)]
    parts += [md.scored(model, test, name) for name, model in models.items()]
    rows = stage(reduce(DataFrame.unionByName, parts), "model-scores")
    return rk.average_precision(rows).join(rk.threshold_metrics(rows, 0.5), "model").orderBy(F.desc("average_precision"))


@query("ablation")
def ablation(spark, sf):
    """The selected model with and without ``same_account``, on the same test fold."""
    test = test_fold(spark, sf)
    full, less = (md.scored(fitted(spark, sf, md.SELECTED, drop), test, md.SELECTED) for drop in ((), ("same_account",)))
    return md.ablation(full, less, "same_account")


@query("score_batch")
def score_batch(spark, sf):
    return md.score_batch(fitted(spark, sf, md.SELECTED), test_fold(spark, sf))


@query("score_parity")
def score_parity(spark, sf):
    """A saved and reloaded model scores the test fold like the one in memory."""
    model = fitted(spark, sf, md.SELECTED)
    path = new_path(spark, "model")
    model.write().overwrite().save(path)
    test = test_fold(spark, sf)
    return md.score_parity(
        md.score_batch(model, test), md.score_batch(PipelineModel.load(path), test), SCORE_PARITY_TOLERANCE
    )


@query("score_contract", FEAT + f"""
select row_id, round(cast({points('rule_a')} as double) / 1000, 6) as risk_score, cast({points('rule_a')} as double) / 1000 >= {THRESHOLD} as is_alert,
       {THRESHOLD}e0 as threshold, '0.1.0' as model_version from f""")
def score_contract(spark, sf):
    return md.with_contract(features(spark, sf), rule_score("rule_a"), THRESHOLD).select("row_id", *md.OUTPUT_CONTRACT)


@query("traffic_summary", FEAT + f""", s as (select payment_format, cast({points('rule_a')} as double) / 1000 as score from f)
select payment_format, count(*) as requests, count(*) filter (score >= {THRESHOLD}) as alerts,
       round(count(*) filter (score >= {THRESHOLD}) / count(*), 6) as alert_rate, round(avg(score), 6) as score_mean,
       min(score) as score_min, max(score) as score_max from s group by 1""")
def traffic_summary(spark, sf):
    return traffic_by_format(features(spark, sf).withColumn("score", rule_score("rule_a")), THRESHOLD)


# --- attribution ------------------------------------------------------------------

_W = {"payment_format": "case when payment_format in ('purchase', '1-URGENT') then 400 else 0 end", "amount_paid": "0",
      "is_business_hours": "50 * is_business_hours", "same_account": "30 * (1 - same_account)",
      "sender_previous_tx_count": "20 * least(sender_previous_tx_count, 5)", "noise": "16 * j"}
_V = {"payment_format": "case when payment_format in ('purchase', '1-URGENT') then 1 else 0 end", "amount_paid": "amount_paid",
      "is_business_hours": "is_business_hours", "same_account": "same_account",
      "sender_previous_tx_count": "sender_previous_tx_count", "noise": "j"}

SHAP = FEAT + ", mu as (select " + ", ".join(f"avg({w}) as m_{f}" for f, w in _W.items()) + " from f), shap as materialized (" + " union all ".join(
    f"select row_id, '{f}' as feature, {w} - m_{f} as phi, cast({_V[f]} as double) as value from f, mu" for f, w in _W.items()) + ")"


def _rule_values(spark, sf) -> DataFrame:
    rows = features(spark, sf)
    return at.additive_attribution(rows, rule_terms("rule_a"), rows)


@query("shapley_rule", SHAP + f"""
select row_id, feature, round(phi, 6) + 0.0e0 as phi, round((select {' + '.join('m_' + f for f in _W)} from mu), 6) as base from shap""")
def shapley_rule(spark, sf):
    return _rule_values(spark, sf)


@query("shapley_global", SHAP + "select feature, round(avg(abs(phi)), 6) as mean_abs_phi from shap group by 1")
def shapley_global(spark, sf):
    return at.global_importance(_rule_values(spark, sf))


@query("shapley_direction", SHAP + """,
q as (select feature, bool_and(value in (0, 1)) as is_binary, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3, avg(abs(phi)) as mean_abs_phi
      from shap group by 1),
m as (select feature, is_binary, mean_abs_phi, avg(phi) filter (case when is_binary then value = 0 else value <= q1 end) as lo,
             avg(phi) filter (case when is_binary then value = 1 else value >= q3 end) as hi from shap join q using (feature) group by all)
select feature, case when is_binary then 'binary' else 'numeric' end as kind, round(lo, 6) + 0.0e0 as low_mean, round(hi, 6) + 0.0e0 as high_mean,
       round(hi - lo, 6) + 0.0e0 as high_minus_low, round(mean_abs_phi, 6) as mean_abs_phi,
       case when hi - lo > 0 then 'increases' when hi - lo < 0 then 'decreases' else 'none' end as direction from m""")
def shapley_direction(spark, sf):
    rows = features(spark, sf)
    terms = rule_terms("rule_a")
    shown = {
        "payment_format": (F.col("payment_format").isin("purchase", "1-URGENT")).cast("double"),
        "noise": terms["noise"] / 16,
    }
    keep = ["payment_format", "amount_paid", "is_business_hours", "same_account", "sender_previous_tx_count", "row_id"]
    cells = at.additive_cells(rows, terms, rows, keep)
    phis = {f: F.col("cells")[i]["phi"] for i, f in enumerate(terms)}
    return at.direction_summary(cells, {f: shown.get(f, F.col(f) if f != "noise" else None) for f in terms}, phis)


@query("shapley_top3", SHAP + """
select row_id, effect, place, feature, round(phi, 6) as phi from (
  select *, row_number() over (partition by row_id, effect order by abs(phi) desc, feature) as place
  from (select *, case when phi > 0 then 'increases' else 'decreases' end as effect from shap where phi <> 0) x) y where place <= 3""")
def shapley_top3(spark, sf):
    rows = features(spark, sf)
    return at.top_contributions(at.additive_cells(rows, rule_terms("rule_a"), rows))


@query("shapley_cases", SHAP + f""", sc as (select row_id, is_laundering as label, cast({points('rule_a')} as double) / 1000 as score from f), cases as (
select case when label = 1 then 'true_positive' else 'false_positive' end as "case", row_id
from (select *, row_number() over (partition by label order by score desc, row_id) as r from sc where score >= {THRESHOLD}) z where r = 1)
select "case", row_id, effect, place, feature, round(phi, 6) as phi from (
  select *, row_number() over (partition by row_id, effect order by abs(phi) desc, feature) as place
  from (select *, case when phi > 0 then 'increases' else 'decreases' end as effect from shap join cases using (row_id) where phi <> 0) x) y where place <= 3""")
def shapley_cases(spark, sf):
    """The strongest contributions of the best-scored true and false alert."""
    cases = rk.top_cases(scored(spark, sf).filter("model = 'rule_a'"), THRESHOLD).select("case", "row_id")
    rows = features(spark, sf)
    chosen = at.additive_cells(rows, rule_terms("rule_a"), rows).join(F.broadcast(cases), "row_id")  # two rows
    return at.top_contributions(chosen, ("case", "row_id"))


def _model_values(spark, sf) -> tuple[PipelineModel, DataFrame, DataFrame]:
    model = fitted(spark, sf, md.SELECTED)
    rows = stage(prep.seeded_sample(test_fold(spark, sf), ATTRIBUTION_SAMPLE_ROWS), "explained")
    return model, rows, tree_attribution(model, rows)


@query("shapley_local")
def shapley_local(spark, sf):
    return at.to_long(_model_values(spark, sf)[2])


@query("shapley_additivity")
def shapley_additivity(spark, sf):
    model, rows, wide = _model_values(spark, sf)
    wide = stage(wide, "shapley")
    scores = md.score_batch(model, rows).withColumnRenamed("risk_score", "score")
    check = "n_rows long, max_abs_error double, within_tolerance boolean, check string"
    sums = at.additivity(wide).withColumn("check", F.lit("additivity"))
    fresh = at.margin_checks(wide, scores).withColumn("check", F.lit("sigmoid"))
    return sums.unionByName(fresh).to(spark.createDataFrame([], check).schema)
