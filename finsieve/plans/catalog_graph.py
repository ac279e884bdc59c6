"""Queries over the payment graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from finsieve.operators import graph as gr
from finsieve.operators.rolling import HOUR
from finsieve.plans.registry import TX, query
from finsieve.plans.views import ledger

COMPONENTS_SQL = """
e as (select distinct account as s, counterparty as t from {rows}),
v as materialized (select distinct x from (select s as x from e union all select t from e)),
l as materialized (select s as a, t as b from e union select t, s from e),
cc(x, c) using key (x) as (
  select x, x as c from v
  union (select distinct on (u.x) u.x, o.c from recurring.cc u join l on l.a = u.x join cc o on o.x = l.b where o.c < u.c order by u.x, o.c))
select x as account, c as component, count(*) over (partition by c) as n_accounts from cc"""
_RECURSIVE_TX = TX.replace("with tx as", "with recursive tx as", 1)


@query("components", _RECURSIVE_TX + ", " + COMPONENTS_SQL.format(rows="tx"))
def components(spark, sf):
    return gr.components(gr.edges(ledger(spark, sf)))


@query("components_illicit", _RECURSIVE_TX + ", " + COMPONENTS_SQL.format(rows="tx where is_laundering = 1 and payment_format = '5-LOW'"))
def components_illicit(spark, sf):
    """Rings of accounts that only low-priority illicit payments tie together."""
    return gr.components(gr.edges(ledger(spark, sf).filter("is_laundering = 1 and payment_format = '5-LOW'")))


@query("hubs")
def hubs(spark, sf):
    return gr.hubs(gr.edges(ledger(spark, sf)))


_WITHIN = 180 * 24 * HOUR


@query("cycles2", TX + f""", i as materialized (select account as s, counterparty as t, epoch_us(ts) as tm, count(*) as n from tx where account <> counterparty group by all),
x as (select a.s as p0, a.t as p1, a.tm, a.n, min(b.tm) as fin from i a join i b on b.s = a.t and b.t = a.s and b.tm > a.tm group by all)
select p0, p1, cast(sum(n) as bigint) as n_cycles, make_timestamp(min(tm)) as first_ts, min(fin - tm) as fastest_us from x where fin - tm <= {_WITHIN} group by 1, 2""")
def cycles2(spark, sf):
    return gr.cycles(ledger(spark, sf), 2, _WITHIN)


@query("cycles3", TX + f""", i as materialized (select account as s, counterparty as t, epoch_us(ts) as tm, count(*) as n from tx where account <> counterparty group by all),
x as (select a.s as p0, a.t as p1, b.t as p2, a.tm, a.n, min(b.tm) as mid from i a join i b on b.s = a.t and b.t <> a.s and b.tm > a.tm group by all),
y as (select p0, p1, p2, x.tm, x.n, min(c.tm) as fin from x join i c on c.s = p2 and c.t = p0 and c.tm > mid group by all)
select p0, p1, p2, cast(sum(n) as bigint) as n_cycles, make_timestamp(min(tm)) as first_ts, min(fin - tm) as fastest_us from y where fin - tm <= {_WITHIN} group by 1, 2, 3""")
def cycles3(spark, sf):
    return gr.cycles(ledger(spark, sf), 3, _WITHIN)
