"""Queries: scans, data quality, features and rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from finsieve.constants import TX_COLUMNS
from finsieve.functions.columns import flag_differs, flag_equal, is_multiple_of, log_amount
from finsieve.operators import features as ft, prep, rates, validation as dq
from finsieve.plans.registry import DIRTY, FEAT, TX, query
from finsieve.plans.views import features, ledger, prepared
from finsieve.session import new_path
from finsieve.sources import ledger as src

TS_FORMAT = "yyyy-MM-dd HH:mm"


@query("scan_ledger", TX + """
select ts, from_bank, account, to_bank, counterparty, round(amount_received, 6) as amount_received, receiving_currency,
       round(amount_paid, 6) as amount_paid, payment_currency, payment_format, is_laundering from tx""")
def scan_ledger(spark, sf):
    path = new_path(spark, "ledger-text")
    src.write_ledger_text(ledger(spark, sf), path)
    return dq.validate_ledger(src.parse_timestamps(src.scan_ledger_text(spark, path)))


@query("scan_ledger_reordered", TX + """
select ts, from_bank, account, to_bank, counterparty, round(amount_received, 6) as amount_received, receiving_currency,
       round(amount_paid, 6) as amount_paid, payment_currency, payment_format, is_laundering from tx""")
def scan_ledger_reordered(spark, sf):
    """Text whose columns stand in another order, among others, with the counterparty under a repeated name."""
    path = new_path(spark, "ledger-text")
    cells = {n: F.date_format(c, src.LEDGER_TS_FORMAT) if c == "ts" else F.col(c) for n, c in zip(src.LEDGER_HEADER, TX_COLUMNS)}
    order = sorted(cells, key=lambda n: (n.endswith(".1"), n[::-1]))
    text = F.to_csv(F.struct(F.lit("x").alias("note"), *[cells[n].alias(n) for n in order], F.lit(1).alias("rank")))
    head = ",".join(["Note", *[n.removesuffix(".1") for n in order], "Rank"])
    rows = ledger(spark, sf).select(text.alias("value"))
    # Every file begins with the header: one line in front of each task's rows.
    rows.mapInArrow(src.headed(head), "value string").write.text(path)
    return dq.validate_ledger(src.parse_timestamps(src.scan_ledger_text(spark, path)))


@query("prepared_split", FEAT + """
select split, payment_format, count(*) as n, cast(sum(is_laundering) as bigint) as n_positive
from f where split = 'train' group by 1, 2""")
def prepared_split(spark, sf):
    path = new_path(spark, "prepared")
    src.write_prepared(prep.split_by_hash(features(spark, sf)), path)
    train = src.read_prepared(spark, path, "train")
    return train.groupBy("split", "payment_format").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("is_laundering").cast("long")).alias("n_positive")
    )


@query("ledger_fingerprint")
def ledger_fingerprint(spark, sf):
    return src.fingerprint(ledger(spark, sf), ("row_id", *TX_COLUMNS))


@query("ledger_digest", TX + """
select count(*) as n_rows, cast(sum(cast(concat('0x', substr(md5(concat(cast(row_id as string), '|', account, '|', counterparty, '|',
       cast(cast(floor(amount_paid * 100) as bigint) as string), '|', payment_format)), 1, 8)) as bigint)) as bigint) as digest_sum
from tx""")
def ledger_digest(spark, sf):
    text = F.concat_ws(
        "|", F.col("row_id").cast("string"), "account", "counterparty",
        F.floor(F.col("amount_paid") * 100).cast("string"), "payment_format",
    )
    digest = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return ledger(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(digest).alias("digest_sum"))


@query("schema_contract", TX + ", n as (select count(*) as rows from tx) " + " union all ".join(
    [f"select 'presence:{c}' as rule, rows, cast(0 as bigint) as violations from n" for c in TX_COLUMNS]
    + ["select 'binary:is_laundering', rows, (select count(*) from tx where is_laundering not in (0, 1)) from n"]
    + [f"select 'numeric:{c}', rows, (select count(*) from tx where {c} is not null and try_cast({c} as double) is null) from n"
       for c in ("from_bank", "to_bank", "amount_received", "amount_paid")]))
def schema_contract(spark, sf):
    return dq.contract_report(ledger(spark, sf))


@query("dq_target_domain", DIRTY + """
select is_laundering, count(*) as n from dirty where is_laundering is not null and is_laundering not in (0, 1) group by 1""")
def dq_target_domain(spark, sf):
    return dq.target_offenders(prepared(spark, sf, "dirty"))


@query("dq_numeric_cast", DIRTY + """
select 'amount_text' as column_name, count(*) filter (amount_text is not null and try_cast(amount_text as double) is null) as n_failed from dirty
union all
select 'bank_text', count(*) filter (bank_text is not null and try_cast(bank_text as double) is null) from dirty""")
def dq_numeric_cast(spark, sf):
    return dq.numeric_cast_failures(prepared(spark, sf, "dirty"), ("amount_text", "bank_text"))


@query("dq_domain_rules", DIRTY + """, r as (
select row_id, case when coalesce(amount_paid < 0, true) then ',amount_negative' else '' end
  || case when coalesce(sender_previous_tx_count < 0, true) then ',count_negative' else '' end
  || case when coalesce(is_business_hours not in (0, 1), true) then ',hours_flag' else '' end
  || case when coalesce(same_account not in (0, 1), true) then ',account_flag' else '' end
  || case when coalesce(trim(payment_format) = '', true) then ',format_blank' else '' end as why from dirty)
select substr(why, 2) as reasons, count(*) as n, min(row_id) as first_row from r group by 1""")
def dq_domain_rules(spark, sf):
    accepted, rejected = dq.split_by_domain(prepared(spark, sf, "dirty"))
    rows = rejected.select("row_id", F.array_join("reasons", ",").alias("reasons")).unionByName(
        accepted.select("row_id", F.lit("").alias("reasons"))
    )
    return rows.groupBy("reasons").agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first_row"))


_MAYBE_NULL = ("ts_text", "account", "amount_text", "amount_paid", "payment_format", "is_laundering")


@query("dq_missing", DIRTY + " union all ".join(
    f" select '{c}' as column_name, count(*) filter ({c} is null) as n_missing, "
    f"round(100.0e0 * count(*) filter ({c} is null) / count(*), 6) as pct_missing from dirty" for c in _MAYBE_NULL))
def dq_missing(spark, sf):
    return dq.missing_profile(prepared(spark, sf, "dirty"), _MAYBE_NULL)


_DUP = ("ts_text", "account", "amount_text", "bank_text", "payment_format", "is_laundering")


@query("dq_duplicates", DIRTY + f"""
select cast(sum(n) as bigint) as n_rows, cast(sum(n - 1) as bigint) as n_duplicates
from (select count(*) as n from dirty group by {', '.join(_DUP)}) g""")
def dq_duplicates(spark, sf):
    return dq.duplicate_count(prepared(spark, sf, "dirty"), _DUP)


@query("dq_timestamps", DIRTY + """
select count(*) filter (t is null) as n_failed, min(t) as ts_min, max(t) as ts_max
from (select try_strptime(ts_text, '%Y-%m-%d %H:%M') as t from dirty) p""")
def dq_timestamps(spark, sf):
    return dq.timestamp_profile(prepared(spark, sf, "dirty"), "ts_text", TS_FORMAT)


_NUM = ("amount_received", "amount_paid", "sender_previous_tx_count")


@query("profile_numeric", FEAT + " union all ".join(f"""
select '{c}' as column_name, count({c}) as n, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std,
       round(cast(min({c}) as double), 4) as min, round(quantile_cont(cast({c} as double), 0.25), 4) as p25,
       round(quantile_cont(cast({c} as double), 0.5), 4) as p50, round(quantile_cont(cast({c} as double), 0.75), 4) as p75,
       round(cast(max({c}) as double), 4) as max from f""" for c in _NUM), digits=4)
def profile_numeric(spark, sf):
    return dq.numeric_profile(features(spark, sf), _NUM)


_CATS = ("account", "counterparty", "from_bank", "to_bank", "payment_format", "payment_currency", "receiving_currency")


@query("profile_cardinality", TX + " union all ".join(
    f" select '{c}' as column_name, count(distinct {c}) as n_distinct from tx" for c in _CATS))
def profile_cardinality(spark, sf):
    return dq.cardinality(ledger(spark, sf), _CATS)


@query("top_formats", TX + "select payment_format, count(*) as n from tx group by 1 order by n desc, 1 limit 10")
def top_formats(spark, sf):
    return dq.value_counts(ledger(spark, sf), "payment_format", 10)


@query("top_illicit_senders", TX + """
select account, count(*) as n from tx where is_laundering = 1 group by 1 order by n desc, account limit 10""")
def top_illicit_senders(spark, sf):
    return dq.value_counts(ledger(spark, sf).filter("is_laundering = 1"), "account", 10)


@query("top_illicit_receivers", TX + """
select counterparty, count(*) as n from tx where is_laundering = 1 group by 1 order by n desc, counterparty limit 10""")
def top_illicit_receivers(spark, sf):
    return dq.value_counts(ledger(spark, sf).filter("is_laundering = 1"), "counterparty", 10)


@query("share_cross_currency", TX + """
select case when payment_currency <> receiving_currency then 1 else 0 end as is_cross_currency, count(*) as n,
       round(100.0e0 * count(*) / (select count(*) from tx), 6) as pct from tx group by 1""")
def share_cross_currency(spark, sf):
    flagged = ledger(spark, sf).withColumn("is_cross_currency", flag_differs("payment_currency", "receiving_currency"))
    return dq.value_shares(flagged, "is_cross_currency")


@query("dq_nonpositive", DIRTY + """
select count(*) filter (amount_paid <= 0) as n_nonpositive, count(*) as n_rows,
       round(100.0e0 * count(*) filter (amount_paid <= 0) / count(*), 6) as pct_nonpositive from dirty""")
def dq_nonpositive(spark, sf):
    return dq.nonpositive_amounts(prepared(spark, sf, "dirty"))


# --- features ---------------------------------------------------------------------


@query("feat_temporal", FEAT + "select row_id, ts, hour, is_business_hours from f")
def feat_temporal(spark, sf):
    return ft.add_temporal(ledger(spark, sf)).select("row_id", "ts", "hour", "is_business_hours")


@query("feat_same_account", FEAT + "select row_id, account, counterparty, same_account from f")
def feat_same_account(spark, sf):
    return ft.add_same_account(ledger(spark, sf)).select("row_id", "account", "counterparty", "same_account")


@query("feat_log", FEAT + """
select row_id, round(ln(1 + greatest(amount_paid, 0)), 6) as log_amount_paid,
       round(ln(1 + sender_previous_tx_count), 6) as log_prior_count from f""")
def feat_log(spark, sf):
    return features(spark, sf).select(
        "row_id", log_amount("amount_paid").alias("log_amount_paid"),
        log_amount("sender_previous_tx_count").alias("log_prior_count"),
    )


@query("feat_model", FEAT + """
select row_id, payment_format, round(amount_paid, 6) as amount_paid, sender_previous_tx_count, is_business_hours, same_account from f""")
def feat_model(spark, sf):
    return ft.model_features(ledger(spark, sf).drop("is_laundering"))


@query("feat_sender_prev_count", FEAT + "select row_id, account, sender_previous_tx_count from f")
def feat_sender_prev_count(spark, sf):
    rows = ledger(spark, sf).select("row_id", "account", "ts")
    return ft.add_prior_count(rows).select("row_id", "account", "sender_previous_tx_count")


@query("feat_account_days", TX + """, d as (select account, count(distinct cast(ts as date)) as account_n_days from tx group by 1)
select row_id, account, account_n_days, case when account_n_days = 1 then 1 else 0 end as single_day_account
from tx join d using (account)""")
def feat_account_days(spark, sf):
    rows = ledger(spark, sf).select("row_id", "account", "ts")
    return ft.add_account_days(rows).select("row_id", "account", "account_n_days", "single_day_account")


# --- rates ------------------------------------------------------------------------


def rate_sql(key: str, name: str, source: str = "f", prefix: str = FEAT, extra: str = "") -> str:
    return prefix + f""", g as (select {key} as {name}, count(*) as n, cast(sum(is_laundering) as bigint) as n_illicit from {source} group by 1),
t as (select cast(sum(n) as double) as rows, cast(sum(n_illicit) as double) as bad from g)
select {name}, n, n_illicit, round(n_illicit / n, 6) as rate, round(100.0e0 * n / rows, 6) as pct_of_tx,
       round(100.0e0 * n_illicit / bad, 6) as pct_of_illicit, round((n_illicit / n) / (bad / rows), 6) as lift{extra} from g, t"""


@query("rate_payment_format", rate_sql(
    "payment_format", "payment_format",
    extra=", round(100.0e0 * n_illicit / n, 6) as illicit_rate_pct, round(100.0e0 - 100.0e0 * n_illicit / n, 6) as legit_rate_pct"))
def rate_payment_format(spark, sf):
    return rates.format_table(ledger(spark, sf))


@query("rate_same_bank", rate_sql("case when from_bank = to_bank then 1 else 0 end", "same_bank"))
def rate_same_bank(spark, sf):
    return rates.group_rate(ledger(spark, sf).withColumn("same_bank", flag_equal("from_bank", "to_bank")), "same_bank")


@query("rate_cross_currency", rate_sql("case when payment_currency <> receiving_currency then 1 else 0 end", "cross_currency"))
def rate_cross_currency(spark, sf):
    flagged = ledger(spark, sf).withColumn("cross_currency", flag_differs("payment_currency", "receiving_currency"))
    return rates.group_rate(flagged, "cross_currency")


@query("rate_round_amount", rate_sql(
    "concat(case when amount_received % 100 = 0 then '1' else '0' end, case when amount_received % 1000 = 0 then '1' else '0' end)",
    "round_100_1000"))
def rate_round_amount(spark, sf):
    flags = F.concat(is_multiple_of("amount_received", 100).cast("string"), is_multiple_of("amount_received", 1000).cast("string"))
    return rates.group_rate(ledger(spark, sf).withColumn("round_100_1000", flags), "round_100_1000")


@query("rate_by_hour", rate_sql("hour", "hour"))
def rate_by_hour(spark, sf):
    return rates.group_rate(ft.add_temporal(ledger(spark, sf)), "hour")


@query("rate_business_hours", rate_sql("is_business_hours", "is_business_hours"))
def rate_business_hours(spark, sf):
    return rates.group_rate(ft.add_temporal(ledger(spark, sf)), "is_business_hours")


@query("rate_same_account", rate_sql("same_account", "same_account"))
def rate_same_account(spark, sf):
    return rates.group_rate(ft.add_same_account(ledger(spark, sf)), "same_account")


@query("rate_velocity_band", FEAT + """, b as (select unnest(['0', '1', '2-5', '6-20', '21-100', '100+']) as band),
v as (select case when sender_previous_tx_count <= 0 then '0' when sender_previous_tx_count <= 1 then '1'
             when sender_previous_tx_count <= 5 then '2-5' when sender_previous_tx_count <= 20 then '6-20'
             when sender_previous_tx_count <= 100 then '21-100' else '100+' end as band, is_laundering from f),
g as (select b.band, count(v.band) as n, coalesce(cast(sum(is_laundering) as bigint), 0) as n_illicit from b left join v on b.band = v.band group by 1),
t as (select cast(sum(n) as double) as rows, cast(sum(n_illicit) as double) as bad from g)
select band, n, n_illicit, round(n_illicit / nullif(n, 0), 6) as rate, round(100.0e0 * n / rows, 6) as pct_of_tx,
       round(100.0e0 * n_illicit / bad, 6) as pct_of_illicit, round((n_illicit / nullif(n, 0)) / (bad / rows), 6) as lift from g, t""")
def rate_velocity_band(spark, sf):
    return rates.velocity_rates(features(spark, sf))


@query("rate_single_day", rate_sql(
    "case when days = 1 then 1 else 0 end", "single_day_account", "fd",
    FEAT + ", d as (select account, count(distinct cast(ts as date)) as days from f group by 1), fd as (select * from f join d using (account))"))
def rate_single_day(spark, sf):
    rows = ledger(spark, sf).select("account", "ts", "is_laundering")
    return rates.group_rate(ft.add_account_days(rows), "single_day_account")


@query("rate_bank_min_support", rate_sql("from_bank", "from_bank") + " where n >= 1000 order by n_illicit / n desc, from_bank limit 10")
def rate_bank_min_support(spark, sf):
    return rates.bank_rates(ledger(spark, sf))


@query("bank_spread", TX + """
select count(*) as n_banks, count(*) filter (n >= 1000) as n_supported, count(*) filter (bad > 0) as n_with_illicit
from (select from_bank, count(*) as n, sum(is_laundering) as bad from tx group by 1) g""")
def bank_spread(spark, sf):
    return rates.bank_spread(ledger(spark, sf))


@query("illicit_entities", TX + """
select count(*) as n_illicit, count(distinct account) as n_senders, count(distinct counterparty) as n_receivers
from tx where is_laundering = 1""")
def illicit_entities(spark, sf):
    return rates.illicit_entities(ledger(spark, sf))


@query("crosstab_same_format", FEAT + """, r as (select distinct same_account from f), c as (select distinct payment_format from f)
select r.same_account, c.payment_format, count(f.row_id) as n
from r cross join c left join f on f.same_account is not distinct from r.same_account and f.payment_format is not distinct from c.payment_format group by 1, 2""")
def crosstab_same_format(spark, sf):
    return rates.contingency(ft.add_same_account(ledger(spark, sf)), "same_account", "payment_format")


_REDUNDANT = ("same_bank", "same_account", "amount_paid", "amount_received")
_MATRIX = ("amount_paid", "sender_previous_tx_count", "is_business_hours", "same_account", "is_laundering")


def matrix_sql(columns, source):
    cells = ", ".join(
        f"corr(cast({a} as double), cast({b} as double)) as c{i}_{j}"
        for i, a in enumerate(columns) for j, b in enumerate(columns) if i < j)
    rows = " union all ".join(
        f"select '{a}' as i, '{b}' as j, " + ("1.0e0" if i == j else f"round(c{min(i, j)}_{max(i, j)}, 6) + 0.0e0") + " as r from m"
        for i, a in enumerate(columns) for j, b in enumerate(columns))
    return f", m as materialized (select {cells} from {source}) {rows}"


@query("corr_redundancy", FEAT + ", fb as (select *, case when from_bank = to_bank then 1 else 0 end as same_bank from f)"
       + matrix_sql(_REDUNDANT, "fb"))
def corr_redundancy(spark, sf):
    rows = ft.add_same_account(ledger(spark, sf)).withColumn("same_bank", flag_equal("from_bank", "to_bank"))
    return rates.correlations(rows, _REDUNDANT)


@query("corr_matrix", FEAT + matrix_sql(_MATRIX, "f"))
def corr_matrix(spark, sf):
    return rates.correlations(features(spark, sf), _MATRIX)


@query("quartiles_by_class", TX + """
select is_laundering, count(*) as n, round(min(amount_paid), 4) as min, round(quantile_cont(amount_paid, 0.25), 4) as p25,
       round(quantile_cont(amount_paid, 0.5), 4) as p50, round(quantile_cont(amount_paid, 0.75), 4) as p75,
       round(max(amount_paid), 4) as max from tx group by 1""", digits=4)
def quartiles_by_class(spark, sf):
    return rates.class_quartiles(ledger(spark, sf), "amount_paid")


@query("hist_amount_by_class", TX + """, v as (select is_laundering, ln(1 + greatest(amount_paid, 0)) as x from tx),
e as (select is_laundering, min(x) as lo, (max(x) - min(x)) / 60 as w, count(x) as total from v group by 1),
b as (select is_laundering, w, total, unnest(range(60)) as bin from e),
h as (select is_laundering, cast(least(floor((x - lo) / w), 59) as bigint) as bin, count(*) as k from v join e using (is_laundering) group by 1, 2)
select is_laundering, cast(bin as integer) as bin, coalesce(k, 0) as n, round(coalesce(k, 0) / (total * w), 6) as density
from b left join h using (is_laundering, bin)""")
def hist_amount_by_class(spark, sf):
    return rates.class_histogram(ledger(spark, sf), log_amount("amount_paid"), 60)


@query("visual_sample", TX + """, l as (select *, row_number() over (order by md5(concat('42-', cast(row_id as string))), row_id) as rk from tx where is_laundering = 0)
select row_id, is_laundering, round(ln(1 + greatest(amount_paid, 0)), 6) as log_amount_paid from l where rk <= 50000
union all select row_id, is_laundering, round(ln(1 + greatest(amount_paid, 0)), 6) from tx where is_laundering = 1""")
def visual_sample(spark, sf):
    return rates.visual_sample(ledger(spark, sf)).select("row_id", "is_laundering", log_amount("amount_paid").alias("log_amount_paid"))
